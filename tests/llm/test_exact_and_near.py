import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from foliant.llm import exact_dedup, near_dedup
from foliant.llm.components import components
from foliant.llm.queries import table


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def test_exact_dedup_against_grouping(docs):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a", "A", "É", "é", "", None, "long " * 5000, f"own {i}"])) for i in range(400)]
    rows += [(None, "a"), (None, "only null"), (None, "only null"), (7, "twice"), (7, "twice")]
    got = exact_dedup.decide(docs(rows), counters=3).toPandas()
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(low(t).encode()).digest()].append(i)
    assert len(got) == len(rows)
    for digest, own in got.groupby(got["digest"].map(bytes)):
        ids = groups[digest]
        best = max((x for x in ids if x is not None), default=None)
        assert (own["group_size"] == len(ids)).all() and own["kept"].sum() == 1
        assert own["keep_id"].isna().all() if best is None else (own["keep_id"] == best).all()
        assert own.loc[own["kept"], "doc_id"].isna().all() if best is None else (own.loc[own["kept"], "doc_id"] == best).all()
    kept = exact_dedup.dedup(docs(rows), counters=3)
    assert kept.count() == len(groups) and kept.columns == docs(rows).columns


def test_frequent_digests_are_all_found(docs):
    rows = ["hot"] * 60 + ["warm"] * 30 + [f"x{i}" for i in range(110)]
    digests = docs(rows).select(exact_dedup.digest("text").alias("digest"))
    found = {bytes(r[0]) for r in exact_dedup.frequent(digests.repartition(5), 6).collect()}
    assert {hashlib.sha256(b"hot").digest(), hashlib.sha256(b"warm").digest()} <= found and len(found) <= 6


def test_exact_dedup_of_nothing(docs):
    assert exact_dedup.decide(docs([])).count() == 0 and exact_dedup.dedup(docs([])).count() == 0


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size=near_dedup.SIZE, threshold=near_dedup.THRESHOLD):
    """component of each row, by comparing all pairs of sets that share a shingle."""
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    pairs = {p for h in holders.values() for p in itertools.combinations(h, 2)}
    for a, b in pairs:
        inter = len(sets[a] & sets[b])
        if 100 * inter >= threshold * (len(sets[a]) + len(sets[b]) - inter):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min(least.get(r, i), i)
    return [(i, len(s), least[find(k)] if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def varied(rng, base, edits, word):
    words = base.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = word()
    return " ".join(words)


def near_rows(n_hot):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    text = lambda n: " ".join(word() for _ in range(n))
    rows, hot = [], text(140)
    rows += [varied(rng, hot, rng.randint(0, 14), word) for _ in range(n_hot)]
    for _ in range(40):
        base = text(rng.randint(1, 200))
        rows += [varied(rng, base, rng.randint(0, 5), word) for _ in range(rng.randint(1, 4))]
    rows += ["", None, " \n\t", "one", "One", "a b", "a b c", "A  b\nc", text(3000), "x " * 5000]
    return list(enumerate(rows))


def check_near(docs, rows, size=3, threshold=85):
    got = near_dedup.resolve(docs(rows), size, threshold).toPandas().sort_values("doc_id")
    want = brute(rows, size, threshold)
    assert [tuple(x) for x in got[["doc_id", "n_shingles", "component_id"]].to_numpy()] == want
    assert (got["kept"] == (got["doc_id"] == got["component_id"])).all()


@pytest.mark.parametrize("size, threshold", [(3, 85), (5, 80)])
def test_near_dedup_against_all_pairs(docs, size, threshold):
    check_near(docs, near_rows(60), size, threshold)


def test_near_dedup_in_blocks_loses_no_link(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    check_near(docs, near_rows(120))


def test_near_dedup_narrows_templates_and_loses_no_link(docs, monkeypatch):
    """Pages of one template are a cluster of many blocks without links; three near copies among them are still found, and few sets are compared."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda n: " ".join(word() for _ in range(n))
    template = text(130)
    rows = [f"{template} {text(70)}" for _ in range(240)]
    rows += [varied(rng, rows[7], 3, word), varied(rng, rows[7], 3, word), varied(rng, rows[90], 2, word)]
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    monkeypatch.setattr(near_dedup, "PIVOTS", 2)
    seen, real = [], near_dedup.verified
    monkeypatch.setattr(near_dedup, "verified", lambda r, *rest: (seen.append(r.count()), real(r, *rest))[1])
    check_near(docs, list(enumerate(rows)), 3, 85)
    assert len(seen) == 2 and seen[1] < 20 and seen[0] < 2 * len(rows)  # linear: not a row for each pair of blocks


def test_bands_miss_no_pair_at_the_threshold():
    assert near_dedup.band_rows(85) == 6 and near_dedup.band_rows(80) == 5 and near_dedup.band_rows(1) == 1


@pytest.mark.parametrize("dedup, stay", [(exact_dedup.dedup, 5), (near_dedup.dedup, 6)])  # near: x and X, whose ids are null, both stay
def test_rows_that_stay_keep_all_their_columns(docs, dedup, stay):
    rows = docs([(i, f"{'abc'[i % 3]} one two three four") for i in range(9)] + [(None, "x"), (None, "X"), (None, None), (3, "a one two three four")])
    own = {tuple(r) for r in rows.collect()}
    got = [tuple(r) for r in dedup(rows).collect()]
    assert set(got) <= own and len(got) == len(set(got)) == stay and dedup(rows).columns == rows.columns


def test_near_dedup_repeated_and_null_ids(docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, "w x y z"), (None, None), (9, "p q r s"), (9, "other words here now")]
    got = near_dedup.resolve(docs(rows)).toPandas()
    assert len(got) == len(rows)
    assert (got.loc[got["doc_id"] == 5, "component_id"] == 5).all() and (got.loc[got["doc_id"] == 9, "component_id"] == 9).all()
    kept = near_dedup.dedup(docs(rows))
    assert kept.filter("text = 'a b c d'").count() == 1 and kept.columns == docs(rows).columns
    assert near_dedup.resolve(docs([])).count() == 0


def test_near_dedup_on_the_documents(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = near_dedup.resolve(d, 3, 85).toPandas().sort_values("doc_id")
    want = brute([(r["doc_id"], r["text"]) for r in d.orderBy("doc_id").collect()], 3, 85)
    assert [tuple(x) for x in got[["doc_id", "n_shingles", "component_id"]].to_numpy()] == want


def test_sketch_estimates_and_fills():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 2**63, (30, 190)).astype(np.uint64)
    two = np.concatenate([one[:, :95], rng.integers(0, 2**63, (30, 95)).astype(np.uint64)], axis=1)
    h = np.concatenate([one, two]).reshape(-1)
    s = near_dedup.sketch(np.repeat(np.arange(60), 190), h, 60)
    assert abs((s[:30] == s[30:]).mean() - 1 / 3) < 0.03
    few = near_dedup.sketch(np.array([0, 1, 1]), np.array([3, 4, 5], np.uint64), 2)
    assert (few != np.uint64(2**64 - 1)).all()


@pytest.mark.parametrize("n", [1, 2, 50])
def test_components_of_a_path_and_a_star(spark, n):
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1001 + i) for i in range(n)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(n + 1)}, **{1000 + i: 1000 for i in range(n + 1)}}
