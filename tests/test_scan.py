"""Values carried over segments, and the review parser on volumes of many segments, against plain loops."""

import random
import re

import pytest
from pyspark.sql import functions as F

from foliant.operators import parsing, scan


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_carried_against_a_loop(spark, width):
    rng = random.Random(width)
    rows = [(k, at, rng.choice([None, None, rng.randint(0, 9)])) for k in ("a", "b", None) for at in sorted(rng.sample(range(400), 120))]
    got = scan.carried(spark.createDataFrame(rows, "vol string, line_no int, x int").repartition(5), "vol", last={"x": F.col("x"), "pair": F.when(F.col("x").isNotNull(), F.struct("line_no", "x"))}, sums={"n": F.lit(1), "s": F.col("x")}, nexts={"after": F.col("x")}, width=width)
    want = []
    for k in ("a", "b", None):
        own, held, total = [r for r in rows if r[0] == k], None, 0
        for j, (_, at, x) in enumerate(own):
            held = (at, x) if x is not None else held
            total += x or 0
            want.append((k, at, held and held[1], held, j + 1, total, own[j + 1][2] if j + 1 < len(own) else None))
    assert got.columns == ["vol", "line_no", "x", "pair", "n", "s", "after"]
    assert sorted([(r.vol, r.line_no, r.x, r.pair and tuple(r.pair), r.n, r.s, r.after) for r in got.collect()], key=repr) == sorted(want, key=repr)


def test_carried_of_no_rows(spark):
    assert scan.carried(spark.createDataFrame([], "vol string, line_no int, x int"), "vol", last={"y": F.col("x")}).count() == 0


LINES = [
    "1. That the Minutes of Ascension Presbytery", "2. That the Minutes of *Calvary* Presbytery", "b. with exceptions of substance:", "e. Responses found unsatisfactory:", "d. found satisfactory", "a. Be approved without exception: 1998",
    "Exception: March 7, 1998: BCO 13-6 not recorded at all", "Exception: no quorum was noted", "2) Minutes were not signed by the clerk (BCO 10-4)", "3) tiny", "General: RAO 16-3 no record of a called meeting", "Jan 12, 1997: no quorum", "Response: we agree",
    "Rationale: none given here", "and will correct it.", "", '<a id="ga26-p31"></a>', '<a id="ga26-p32"></a> text', "d That as no response to the 25th GA was submitted", "MINUTES OF THE GENERAL ASSEMBLY", "plain text",
]


def loop(lines, look=899):
    """The parser as one pass over a list of lines: mode from any line."""
    at = lambda k, x: re.search(parsing.REVIEW[k].replace("(?i)", ""), x, re.I if "(?i)" in parsing.REVIEW[k] else 0)
    body = [bool(at("body", x)) for x in lines]
    heads = [(sum(body[i + 1 : i + 1 + look]), -i) for i, x in enumerate(lines) if at("region", x) and not re.search(r"\.\.\.\.|(?i:p\.\s*\d+\s*$)", x)]
    n, start = max(heads, default=(0, 0))
    if not n:
        return []
    stop = next((i for i in range(1 - start, len(lines)) if at("top", lines[i]) and not re.search("Presbytery|Minutes", lines[i])), len(lines))
    who = mode = anchor = None
    item, is_open, out = 0, False, []
    for i in range(-start, stop):
        x = lines[i]
        anchor = at("anchor", x)[1] if at("anchor", x) else anchor
        low = x.lower()
        said = "unsatisfactory" if at("forwarded", x) and not at("response", x) else next((m for w, m in (("unsatisfactory", "unsatisfactory"), ("satisfactory", "satisfactory"), ("without exception", "skip"), ("exception of substance", "raised"), ("exceptions of substance", "raised"), ("exception of form", "skip"), ("exceptions of form", "skip")) if w in low), None)
        if at("body", x):
            who, mode, is_open = re.sub("[*_`]+", "", at("body", x)[1]).strip(), None, False
        elif said:
            mode, is_open = said, False
        elif mode in ("raised", "satisfactory", "unsatisfactory"):
            opens = at("exception", x) or (at("numbered", x) and len(at("numbered", x)[1]) > 12) or at("dated", x)
            item, is_open = item + bool(opens), is_open or bool(opens)
            if is_open:
                out.append((item, who, mode, i + 1, anchor))
    return out


def volume(rng, n):
    lines = [rng.choice(LINES) for _ in range(n)]
    for _ in range(4):
        lines[rng.randrange(n)] = rng.choice(["II. Report concerning the Minutes of presbyteries", "Report concerning the Minutes of .... p. 9", "Report Concerning the Minutes of all"])
    lines[-rng.randint(1, 40)] = "III. Other business"
    return lines


@pytest.mark.parametrize("seed", [1, 2])
def test_review_events_on_any_segments(spark, seed):
    """One volume in one segment and in 50, over 1 and 50 partitions, against the loop."""
    rng = random.Random(seed)
    vols = {f"v{k}": volume(rng, n) for k, n in enumerate((500, 60, 2500))} | {"none": ["plain"] * 30, None: volume(rng, 90)}
    rows = spark.createDataFrame([(v, i + 1, x) for v, lines in vols.items() for i, x in enumerate(lines)], "vol string, line_no int, line string")
    want = sorted([(v, *e) for v, lines in vols.items() for e in loop(lines)], key=repr)
    for parts, width in ((1, 100_000), (50, 50)):
        got = parsing.review_events(rows.repartition(parts), parity=True, width=width)
        assert sorted([(r.vol, r.item, r.body, r.finding, r.line_no, r.page_anchor) for r in got.collect()], key=repr) == want
    assert len(want) > 300
    short = parsing.review_events(rows, parity=True, width=50).groupBy("vol").count().collect()
    assert {r.vol for r in short} == {w[0] for w in want}


def test_look_ahead_reaches_over_segments(spark):
    lines = ["Report concerning the Minutes of A", *["x"] * 30, "Report concerning the Minutes of B", *["1. That the Minutes of Ascension Presbytery"] * 3, *["x"] * 30, "1. That the Minutes of Calvary Presbytery"]
    rows = spark.createDataFrame([("v", i + 1, x) for i, x in enumerate(lines)], "vol string, line_no int, line string")
    for width in (4, 1000):
        assert parsing.review_region(rows, look=20, width=width).agg(F.min("line_no")).first()[0] == 32
        assert parsing.review_region(rows, look=33, width=width).agg(F.min("line_no")).first()[0] == 32  # three of A's, four of B's
        assert parsing.review_region(rows, look=100, width=width).agg(F.min("line_no")).first()[0] == 1  # four of each: the first
