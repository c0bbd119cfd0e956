"""The query language and the stored index."""

import random
import re

import pytest

from foliant.operators import postings, search

TEXTS = {1: "original jurisdiction of the court", 2: "jurisdiction original", 3: None, 4: "an appeal not a complaint", 5: "the appeals court; a complaint", 6: "Appellate COURT of appeal", 7: "café au lait", 8: "", 9: "a_b of C-3"}


def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "id long, text string")


@pytest.mark.parametrize("query, tree", [
    ("a OR b AND c NOT d e", ("or", 0, ("and", 1, ("not", 2, ("and", 3, 4))))), ("a NOT b NOT c", ("not", ("not", 0, 1), 2)), ("(a OR b) c", ("and", ("or", 0, 1), 2)), ("a AND a", ("and", 0, 0)),
    ('"a b" + c d*', ("and", 0, 1)), ("not or and", ("and", ("and", 0, 1), 2)),
])
def test_trees(query, tree):
    assert search.read_query(query).tree == tree


@pytest.mark.parametrize("query", ["", " ", "AND", "a AND", "OR a", "NOT a", "a OR OR b", "(a", "a)", "()", '"a', 'a "b', "a + OR", "+ a", "a NOT AND b", "((a)", "a AND (b OR)"])
def test_queries_that_cannot_be_read(query):
    assert search.read_query(query) is None


@pytest.fixture(scope="module")
def indexes(spark, tmp_path_factory):
    """Postings, one segment, three segments, and these merged."""
    path = tmp_path_factory.mktemp("index")
    one = search.SearchIndex(spark, f"{path}/one").append(docs(spark, TEXTS), "id", "text")
    many = []
    for name in ("three", "merged"):
        own = search.SearchIndex(spark, f"{path}/{name}")
        for k in range(3):
            own.append(docs(spark, {i: t for i, t in TEXTS.items() if i % 3 == k}), "id", "text")
        many.append(own)
    many[1].merge()
    return [search.postings(docs(spark, TEXTS), "id", "text"), one, *many]


@pytest.mark.parametrize("query, found", [
    ("appeal OR complaint", [4, 5, 6]), ("complaint NOT appeal", [5]), ("appe*", [4, 5, 6]), ("appel* OR jurisdiction NOT court", [2, 6]), ("(appe* NOT complaint) OR (original AND (court OR lait))", [1, 6]),
    ('"original jurisdiction"', [1]), ("original + jurisdiction", [1]), ('"of the co" *', [1]), ('"court of" + appeal', [6]), ("CAFÉ", [7]), ("a_b", [9]), ('"a b"', [9]), ("C-3", [9]), ("not", [4]), ("NOT", []), ('"!?" OR lait', [7]), ("lait NOT \"!?\"", [7]),
    ("lait AND court", []), ("zzz* OR nothing", []), ("court (appeal OR original)", [1, 6]), ("court NOT (of OR the)", []),
])
def test_all_indexes_find(indexes, query, found):
    for index in indexes:
        assert sorted(r.doc for r in search.search(index, query).collect()) == found


def holds(tree, leaves, words):
    if isinstance(tree, int):
        ws, prefix = leaves[tree]
        n = len(ws)
        return any(words[i : i + n] == list(ws) or (prefix and words[i : i + n - 1] == list(ws[:-1]) and i + n <= len(words) and words[i + n - 1].startswith(ws[-1])) for i in range(len(words) - n + 1))
    kind, a, b = tree
    left, right = holds(a, leaves, words), holds(b, leaves, words)
    return left or right if kind == "or" else left and (not right if kind == "not" else right)


def test_random_queries_against_a_scan(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(postings, "RANGE", 8)
    monkeypatch.setattr(postings, "FEW", 25)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(1, 3)))
    texts = {i: " ".join(word() for _ in range(rng.choice([0, 2, 6, 20]))) for i in range(80)}
    index = search.SearchIndex(spark, f"{tmp_path}/i")
    for k in range(2):
        index.append(docs(spark, {i: t for i, t in texts.items() if i % 2 == k}), "id", "text")

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([word(), word(), f"{word()}*", f'"{word()} {word()}"', f'"{word()} {word()}" *'])
        return f"({make(depth - 1)}{rng.choice([' AND ', ' OR ', ' NOT ', ' '])}{make(depth - 1)})"

    for _ in range(25):
        text = make(3)
        query = search.read_query(text)
        want = [i for i, t in texts.items() if holds(query.tree, query.leaves, t.split())]
        assert sorted(r.doc for r in search.search(index, text).collect()) == want, text


def test_appending_reads_and_writes_nothing_else(spark, tmp_path):
    index = search.SearchIndex(spark, f"{tmp_path}/i").append(docs(spark, TEXTS), "id", "text")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    index.append(docs(spark, {100: "court of appeal"}), "id", "text")
    assert {p: p.stat().st_mtime_ns for p in before} == before and len(index.live()[1]) == 2
    assert sorted(r.doc for r in search.search(index, "court appeal").collect()) == [6, 100]
    assert index.frequencies([("court", False), ("appeal", False), ("app", True), ("zz", False)]) == {("court", False): 4, ("appeal", False): 3, ("app", True): 5, ("zz", False): 0}


def test_a_failed_append_leaves_the_index_as_it_was(spark, tmp_path):
    index = search.SearchIndex(spark, f"{tmp_path}/i").append(docs(spark, TEXTS), "id", "text")
    with pytest.raises(Exception, match="raise_error|planted"):
        index.append(docs(spark, {50: "court"}).selectExpr("id", "raise_error('planted') AS text"), "id", "text")
    index._write(search.postings(docs(spark, {51: "court"}), "id", "text"), 1)  # written, but not entered
    assert sorted(r.doc for r in search.search(index, "court").collect()) == [1, 5, 6] and len(index.live()[1]) == 1
    index.append(docs(spark, {52: "court"}), "id", "text").merge()
    old = len(list((tmp_path / "i/segments").iterdir()))
    index.sweep()
    assert old >= 4 and len(list((tmp_path / "i/segments").iterdir())) == 1
    assert sorted(r.doc for r in search.search(index, "court").collect()) == [1, 5, 6, 52]


def test_only_asked_blocks_are_scanned(spark, tmp_path):
    index = search.SearchIndex(spark, f"{tmp_path}/i").append(docs(spark, {i: f"common w{i}" for i in range(300)}), "id", "text")
    plan = index.postings([(("w7",), False), (("common",), False)], [[(("w7",), False)], [(("common",), False)]])._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[.*(In\(term|EqualTo\(term|Or\()", plan) and "BroadcastHashJoin" in plan
    empty = search.SearchIndex(spark, f"{tmp_path}/none")
    assert search.search(empty, "court").count() == 0 and empty.merge().sweep().live() == (0, [])


def test_documents_named_by_a_struct(spark, tmp_path):
    pages = spark.createDataFrame([("v1", 1, "court"), ("v1", 2, "the court"), ("v2", 1, "none")], "vol string, page int, text string").selectExpr("struct(vol, page) AS doc", "text")
    index = search.SearchIndex(spark, f"{tmp_path}/i").append(pages, "doc", "text")
    assert sorted((r.doc.vol, r.doc.page) for r in search.search(index, "court").collect()) == [("v1", 1), ("v1", 2)]
