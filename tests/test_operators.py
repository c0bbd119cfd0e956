"""Operators on small frames whose results are known, with the edge cases that the queries' tables lack."""

import datetime

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as fn
from foliant.operators import aliases as aliases_
from foliant.operators import audit, hierarchy, joins, lifecycle, parsing, quality, repair, search
from foliant.sources import readers, sinks
from foliant.streaming import state


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("text, share", [("", 0.0), (None, 0.0), ("a b c word", 0.75), ("Plain words only", 0.0), ("é ä", 1.0), ("x1 2 3", 0.0)])
def test_fragments(spark, text, share):
    assert one(spark, text, quality.fragments) == share


def test_stray_letters_need_a_blank_after(spark):
    assert one(spark, "x a I y word z", quality.stray_letters) == 2


def test_adoption_guard(spark):
    rows = spark.createDataFrame([(5, 2, 100, 85), (4, 0, 100, 100), (10, 6, 100, 100), (10, 5, 100, 84)], "a int, b int, c int, d int")
    assert [r[0] for r in rows.select(quality.adopt(*map(F.col, "abcd"))).collect()] == [True, False, False, False]


def test_headers_go_anywhere_and_numbers_at_the_edges_only(spark):
    text = "JOURNAL\n12\nfirst\n7\nnext line\n9\nmore\n11\nlast\n13"
    got = one(spark, text, repair.strip_headers)
    assert "JOURNAL" not in got and not got.startswith("12") and not got.endswith("13") and "\n9\n" in got
    assert one(spark, "no header\n\n\n\nhere", repair.strip_headers) == "no header\n\n\n\nhere"


@pytest.mark.parametrize("n, text", [(1, "1st"), (2, "2nd"), (3, "3rd"), (11, "11th"), (12, "12th"), (21, "21st"), (112, "112th"), (123, "123rd")])
def test_ordinals(spark, n, text):
    assert one(spark, n, fn.ordinal, "int") == text


def test_case_variants_and_dates(spark):
    assert one(spark, "1998-9", fn.case_variants) == ["1998-09", "1998-9", "98-09", "98-9"]
    assert one(spark, "1988-__", fn.case_variants) == []
    assert one(spark, "2024-02-29", fn.iso_date) == datetime.date(2024, 2, 29) and one(spark, "2024-02-30", fn.iso_date) is None


def test_provisions_keep_order_and_lose_open_brackets(spark):
    assert one(spark, "(see BCO 13-6) and RAO 16-3.e.5, BCO 13-6", parsing.provisions) == ["BCO 13-6", "RAO 16-3.e.5"]
    assert one(spark, None, parsing.provisions) == []


def test_mode_asks_unsatisfactory_first(spark):
    assert one(spark, "Responses found unsatisfactory", parsing.finding_mode) == "unsatisfactory"
    assert one(spark, "found satisfactory", parsing.finding_mode) == "satisfactory"


@pytest.mark.parametrize("phrase, label", [("OO", "Out of Order"), ("wd", "Withdrawn"), ("not in order", "Out of Order"), ("premature", "Withdrawn"), ("not acceded to", "Not Acceded to by the SJC"), ("moot", "Rendered Moot")])
def test_disposition_labels(spark, phrase, label):
    assert one(spark, phrase, parsing.disposition_label) == label


def test_asof_before_on_between_and_without_points(spark):
    left = spark.createDataFrame([("a", 1), ("a", 3), ("a", 4), ("b", 5)], "vol string, line_no int")
    points = spark.createDataFrame([("a", 3, 30), ("a", 9, 90)], "vol string, at int, page int")
    got = {(r.vol, r.line_no): r.page for r in joins.asof(left, points, ["vol"], "line_no", "at", ["page"]).collect()}
    assert got == {("a", 1): None, ("a", 3): 30, ("a", 4): 30, ("b", 5): None}
    clamped = {(r.vol, r.line_no): r.page for r in joins.asof(left, points, ["vol"], "line_no", "at", ["page"], clamp=True).collect()}
    assert clamped[("a", 1)] == 30 and clamped[("b", 5)] is None


def test_one_page_each_counts_earlier_decisions_as_further(spark):
    pages = spark.createDataFrame([("early", ["1995-1"], 1994, "long text"), ("late", ["1995-1"], 2000, "t"), ("other", ["1995-1"], 2000, "tt")], "file string, numbers array<string>, year int, text string")
    best, orphans = joins.one_page_each(pages)
    assert [(r.file, r.distance) for r in best.collect()] == [("other", 5)]
    assert {r.file for r in orphans.collect()} == {"early", "late"}


def test_aliases_of_any_number_of_words_are_found(spark):
    texts = ["The Book of Order applies", "a notebook of ordering", "Committee\ton  Women", "womenfolk and e of o", "xab", "", None, "the whole counsel of God is here", "Book of  Order"]
    names = ["Women", "women", "oke", "book of order", "of order", "order applies", "Book  of", "ttee\ton", "e o", "e of o", "a", "b", "xab", " of ", "God is", "whole counsel of God", "hole counsel of Go", "", " ", "absent", "of absent", "the absent order", "counsel of god", None, "k of o", "and e"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    aliases = spark.createDataFrame(list(enumerate(names)), "alias_id int, alias string")
    got = sorted(tuple(r) for r in aliases_.alias_matches(docs, "doc_id", "text", aliases).collect())
    assert got == sorted((i, d) for i, a in enumerate(names) for d, t in enumerate(texts) if a is not None and t is not None and a.lower() in t.lower())
    gaps, extra, _ = joins.reconcile(aliases.filter("alias_id in (0, 19)"), aliases_.alias_matches(docs, "doc_id", "text", aliases.filter("alias_id in (0, 19)")), docs, "doc_id")
    assert [r.alias_id for r in gaps.collect()] == [19] and sorted(r.doc_id for r in extra.collect()) == [0, 1, 4, 5, 6, 7, 8]


def test_likely_same_compares_all_of_a_block(spark):
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1] / max(len(a), len(b), 1)

    texts = ["Minutes lack the date of the meeting", "The minutes lack the date of the meeting", "No record of examinations", "Minutes lack the dates of a meeting", "Zealous minutes lack the date of meeting", "abcdefg", "abcdefgxyz", "abcdefghij", "", "abc", "Minutes lack the date of the meeting"]
    rows = [(f"t{i}", "west" if i != 3 else None, t, ["9-3"]) for i, t in enumerate(texts)] + [("u", None, "Minutes lack the dates of the meeting", ["9-3", "1-1"]), ("v", "east", texts[0], ["9-3"])]
    got = {frozenset((r.thread, r.other)): r.distance for r in lifecycle.likely_same(spark.createDataFrame(rows, "thread string, body string, description string, provisions array<string>")).collect()}
    want = {frozenset((a[0], b[0])): distance(a[2], b[2]) for k, a in enumerate(rows) for b in rows[:k] if a[1] == b[1] and set(a[3]) & set(b[3]) and distance(a[2], b[2]) <= 0.3}
    assert got == want and frozenset(("t0", "t1")) in got and frozenset(("t5", "t6")) in got


def test_concordance_applies_only_later_events_and_chains(spark):
    schema = "adopted_year int, chapter string, ga int, kind string, status string, mappings array<struct<`from`:string,`to`:string>>"
    events = spark.createDataFrame([(1980, "9", 8, "r", "k", [("9-1", "9-3")]), (1990, "9", 18, "r", "k", [("9-3", "9-7")])], schema)
    cites = spark.createDataFrame([("9-1", 1975), ("9-1", 1980), ("9-3", 1985), ("1-1", 1970)], "section string, year int")
    got = {(r.section, r.year): r.current for r in joins.resolve_sections(cites, readers.events_in_order(events)).collect()}
    assert got == {("9-1", 1975): "9-7", ("9-1", 1980): "9-1", ("9-3", 1985): "9-7", ("1-1", 1970): "1-1"}


def test_search_reads_phrases_groups_and_refuses_nonsense(spark):
    docs = spark.createDataFrame([(1, "original jurisdiction of the court"), (2, "jurisdiction original"), (3, None)], "id int, text string")
    index = search.postings(docs, "id", "text")
    find = lambda q: sorted(r.doc for r in search.search(index, q).collect())
    assert find('"original jurisdiction"') == [1] and find("original AND (court OR nothing)") == [1] and find("original") == [1, 2]
    assert find('"unclosed') == [] and find("") == []


def test_headings_end_deeper_ones(spark):
    rows = readers.lines(spark.createDataFrame([("v", "# A\n## B\ntext\n# C\nmore")], "vol string, text string"), "vol")
    got = {r.line_no: (r.h1, r.h2) for r in hierarchy.headings(rows).collect()}
    assert got[3] == ("A", "B") and got[5] == ("C", None)


def test_audit_gate(spark):
    docs = spark.createDataFrame([("O1", "see [x](a.md) and [y](b.md)")], "entity string, text string")
    found = audit.broken_links(docs, spark.createDataFrame([("a.md",)], "path string"))
    assert [r.detail for r in found.collect()] == ["b.md"]
    audit.gate(found.limit(0))
    with pytest.raises(ValueError, match="broken_link"):
        audit.gate(found)


def test_sources_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    sinks.write_json_lines(rows, f"{tmp_path}/j")
    assert sorted(map(tuple, readers.json_lines(spark, f"{tmp_path}/j", "k string, n int").collect()), key=str) == [("a", 1), ("b", None)]
    assert readers.json_lines(spark, f"{tmp_path}/none", "k string").count() == 0
    assert sinks.json_array(rows, ["k"]).first()["json"] == '[{"k":"a","n":1},{"k":"b","n":null}]'
    (tmp_path / "ga01_1973.md").write_text("one\ntwo")
    assert [tuple(r) for r in readers.text_lines(spark, f"{tmp_path}/ga01_1973.md").collect()] == [("ga01_1973", 1, "one"), ("ga01_1973", 2, "two")]
    (tmp_path / "t.tsv").write_text("k1\tx\ty\nk2\tz\tw\n")
    assert readers.tsv_row(spark, f"{tmp_path}/t.tsv", "k2", 3).first()["c1"] == "z"
    with pytest.raises(LookupError):
        readers.tsv_row(spark, f"{tmp_path}/t.tsv", "k3", 3)


NOTE = "key string, text string, star boolean, lean string, seen string, ts long"


def test_notes_newest_wins_equal_keeps_and_empty_deletes(spark):
    old = spark.createDataFrame([("a", "old", False, None, None, 5), ("b", "old", False, None, None, 5), ("c", "old", False, None, None, 5)], NOTE)
    new = spark.createDataFrame([("a", "new", False, None, None, 6), ("b", "new", False, None, None, 5), ("c", "", False, None, None, 7), ("d", "", True, None, None, 1)], NOTE)
    assert {r.key: r.text for r in state.merge_notes(old, new).collect()} == {"a": "new", "b": "old", "d": ""}
    assert {r.key for r in state.merge_notes(old, new, replace=True).collect()} == {"a", "b", "d"}


def test_notes_on_a_stream_resume(spark, tmp_path):
    def put(rows):
        spark.createDataFrame(rows, NOTE).write.mode("append").json(f"{tmp_path}/in")
        stream = spark.readStream.schema(NOTE).json(f"{tmp_path}/in")
        state.keep_notes(stream, f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()

    put([("a", "one", False, None, None, 2), ("b", "x", False, None, None, 2)])
    put([("a", "late", False, None, None, 1), ("b", "", False, None, None, 3)])
    assert {r.key: r.text for r in state.latest_notes(state.read_notes(spark, f"{tmp_path}/out")).collect()} == {"a": "one"}
