"""What larger tables showed: copies, common keys and rounding at the edges."""

import random

import duckdb
from pyspark.sql import functions as F

from foliant.functions import text as fn
from foliant.operators import joins, lifecycle, parsing, postings, quality, repair, search
from foliant.plans import queries as plans
from foliant.sources import sinks


def same_as_sql(spark, folder, name):
    con = duckdb.connect()
    for f in folder.iterdir():
        con.execute(f"CREATE VIEW {f.name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{f}/*.parquet')")
    want = con.execute(plans.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = [tuple(r) for r in plans.queries()[name](spark, str(folder)).select(*columns).collect()]
    theirs = want.fetchall()
    assert sorted(got, key=repr) == sorted(theirs, key=repr)
    return theirs


def put(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_copies_of_a_description_are_compared_once(spark, monkeypatch):
    made, all_pairs = [], lifecycle.all_pairs
    monkeypatch.setattr(lifecycle, "all_pairs", lambda each: made.append(all_pairs(each)) or made[-1])
    rows = [(f"t{i:04d}", "A", ("large ring", "large rink", "blue anvil")[i % 3], ["9", "8"] if i % 2 else ["9"]) for i in range(400)]
    got = lifecycle.likely_same(spark.createDataFrame(rows, "thread string, body string, description string, provisions array<string>")).collect()
    assert made[0].count() <= 3 * 2  # pairs of texts in two blocks
    n = [sum(r[2] == x for r in rows) for x in ("large ring", "large rink", "blue anvil")]
    assert len(got) == len({(r.thread, r.other) for r in got}) == sum(k * (k - 1) // 2 for k in n) + n[0] * n[1]
    assert {r.distance for r in got} == {0.0, 0.1}


def test_halves_go_to_the_even_number(spark, tmp_path):
    put(spark, tmp_path, "supplier", [(1, 3, 0.0)], "s_suppkey long, s_nationkey int, s_acctbal double")
    put(spark, tmp_path, "customer", [(1, 3, 301.5), (2, 3, 300.5), (3, 3, 1.0)], "c_custkey long, c_nationkey int, c_acctbal double")
    assert same_as_sql(spark, tmp_path, "relink_within_range") == [(1, 2)]


def test_few_real_hits_do_not_count_as_blocks(spark, tmp_path):
    put(spark, tmp_path, "supplier", [(k, n) for k in range(120) for n in range(25)], "s_suppkey long, s_nationkey int")
    assert (8, True, False) in same_as_sql(spark, tmp_path, "location_predicates")


def widest(df):
    """The largest number of rows that a join of the executed plan gives out."""
    df.collect()
    plan, most = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        p = plan.pop()
        for name in ("executedPlan", "plan"):
            if p.getClass().getSimpleName() in ("AdaptiveSparkPlanExec",) and name == "executedPlan" or p.getClass().getSimpleName().endswith("QueryStageExec") and name == "plan":
                plan.append(getattr(p, name)())
        if "Join" in p.nodeName():
            most = max(most, p.metrics().apply("numOutputRows").value())
        kids = p.children()
        plan += [kids.apply(i) for i in range(kids.size())]
    return most


def test_details_of_a_number_do_not_multiply_with_its_files(spark):
    files = spark.createDataFrame([(f"f{i:03d}", ["1990-1", "none", "1990-2"]) for i in range(200)], "file string, numbers array<string>")
    details = spark.createDataFrame([("1990-1", [f"p{i % 3}", None], " ", i) for i in range(150)] + [("1990-2", None, f"d{9 - i}", i) for i in range(5)] + [("1990-2", ["q"], None, 9)], "number string, provisions array<string>, disposition string, _seq int")
    got = joins.search_details(files, details)
    assert {(tuple(r.provisions), r.disposition) for r in got.collect()} == {(("p0", "p1", "p2", "q", None), "d9")} and got.count() == 200
    assert widest(got) <= 600


def test_lines_of_a_number_do_not_multiply_with_its_cases(spark):
    rows = spark.createDataFrame([("v", i * 10, f"1990-1. Complaint of {'A' * (i % 40)} vs. B") for i in range(300)], "vol string, line_no long, line string")
    cases = spark.createDataFrame([(f"c{i}", "v", "1990-1") for i in range(300)], "id string, vol string, number string")
    got = parsing.captions(rows, cases)
    assert {r.caption for r in got.collect()} == {f"Complaint of {'A' * 39} vs. B"} and got.count() == 300
    assert widest(got) <= 600


def test_disposing_lines_do_not_multiply_with_cases(spark):
    rows = [("v", i * 10, f"Case 1990-1 was dismissed {'x' * (i * 7 % 40)}") for i in range(300)]
    asked = [(f"c{i}", "v", ["1990-1", "77-7"], i * 20) for i in range(300)] + [("none", "v", ["1990-1"], None)]
    got = parsing.disposing_sentences(spark.createDataFrame(rows, "vol string, line_no long, line string"), spark.createDataFrame(asked, "id string, vol string, numbers array<string>, region_from long"))
    want = {i: min(rows, key=lambda r: (a is not None and r[1] < a, -len(r[2]), r[1]))[1] for i, _, _, a in asked}
    assert {r.id: r.line_no for r in got.collect()} == want
    assert widest(got) <= 1200


def test_pages_are_read_without_a_list_of_files_on_the_driver(spark, tmp_path):
    sinks.write_pages(spark.createDataFrame([("old", "x")], "slug string, page string"), str(tmp_path))
    pages = [(f"p{i}.md" if i % 3 else f"é {i}", f"# {i}\n\nschön\n") for i in range(60)] + [("none", None)]
    sinks.write_pages(spark.createDataFrame(pages, "slug string, page string"), f"file://{tmp_path}")
    got = sinks.read_pages(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted((s, p or "") for s, p in pages) == sorted(map(tuple, sinks.read_pages(spark, f"file://{tmp_path}").collect()))
    assert not got.inputFiles()
    (tmp_path / "note.txt").write_text("no page")
    assert got.count() == 61


def test_blocks_of_an_index_are_made_where_the_texts_are(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"the word w{i % 7} of the text {i}") for i in range(300)], "doc_id long, text string")
    rows = postings.dealt(docs.select(F.col("doc_id").alias("doc"), "text"), 300).select("range", "doc", F.posexplode(postings.words(F.col("text"))).alias("pos", "term"))
    blocks = postings.blocks_of(rows, F.collect_list("pos"))
    assert blocks._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    index = search.SearchIndex(spark, str(tmp_path / "i")).append(docs.filter("doc_id < 200"), "doc_id", "text").append(docs.filter("doc_id >= 150"), "doc_id", "text")
    place = lambda: sorted((r.term, r.doc, r.pos) for r in index.postings().collect())
    before = place()
    assert place() == before and {r.doc for r in search.search(index.merge().sweep(), '"the text" NOT w3').collect()} == {i for i in range(300) if i % 7 != 3}
    assert place() == before and not list((tmp_path / "i").rglob("unsorted"))


def test_likeness_of_names_is_worked_out_once_a_pair(spark):
    rows = spark.createDataFrame([(["ann", "bob"], ["anm", "bop"])], "a array<string>, b array<string>").select(fn.party_share(F.col("a"), F.col("b")).alias("s"))
    assert rows._jdf.queryExecution().analyzed().expressions().mkString(" ").count("levenshtein(") <= 5
    assert rows.first().s == 0.0  # two letters of three are too few


def test_only_tokens_that_may_spell_a_term_are_looked_at_and_equal_runs_once(monkeypatch):
    cuts, tokens_of = [], repair.tokens_of
    monkeypatch.setattr(repair, "tokens_of", lambda text: cuts.append(text) or tokens_of(text))
    fix = repair.despacer({"common": ["presbytery"]})
    assert fix("zz q qq v " * 500) == "zz q qq v " * 500 and cuts == []
    assert fix("p r e s b y t e r y of " * 500) == "presbytery of " * 500 and cuts == ["p r e s b y t e r y", "presbytery"]


def joined_token_by_token(text, speller, most_tokens):
    tokens, out, done, at = list(repair.tokens_of(text)), [], 0, 0
    while at < len(tokens):
        node, best = 0, None
        for end in range(at, min(at + most_tokens, len(tokens))):
            node = speller.follow(node, tokens[end].letters) if tokens[end].letters else None
            if node is None:
                break
            if end > at and node in speller.terms and repair.fits(speller.terms[node], tokens[at : end + 1]):
                best = end
                term = repair.cased(speller.terms[node], "".join(t.letters for t in tokens[at : end + 1]))
        if best:
            out += [text[done : tokens[at].head], term]
            done, at = tokens[best].tail, best
        at += 1
    return "".join([*out, text[done:]])


def test_joined_as_token_by_token():
    dice, changed = random.Random(10), 0
    for _ in range(400):
        terms = {k: ["".join(dice.choices("abcAB ", k=dice.randint(0, 6))) for _ in range(dice.randint(0, 3))] for k in ("phrase", "common", "name", "shifted")}
        speller, most = repair.Speller(terms | {"common": [*terms["common"], "a" * 14, "abé"]}), dice.choice([2, 4, 12])
        for _ in range(10):
            text = "".join(dice.choice(dice.choices(["abcAB", " \n\x0b", ".-’", "1é$ſ_"], [60, 28, 9, 3])[0]) for _ in range(dice.randint(0, 60)))
            want = joined_token_by_token(text, speller, most)
            assert repair.joined(text, speller, most) == want
            changed += want != text
    assert changed > 100


def test_verdicts_of_odd_documents_in_one_pass_of_texts(spark, tmp_path):
    real = "the church of god and a man "
    odd = [None, "", " ", "a\x0bb c dd", "a  b\u0085 c d ee", "é ü ññ Ω ab́ c", "\t\nI\r\fx", real * 9, "q " * 90, "zz " * 90 + real]
    rows = [(k, text) for k, text in enumerate(odd)] + [(k + 1, text) for k, text in enumerate(odd)] + [(None, real), (None, "q r s")]
    put(spark, tmp_path, "documents", rows, "doc_id long, text string")
    put(spark, tmp_path, "benchmark", [(real,)], "text string")
    verdicts = same_as_sql(spark, tmp_path, "verdicts_after_repair")
    assert len(verdicts) == len(rows) and {v[-1] for v in verdicts} == {"good", "despace", "reocr"}
    same_as_sql(spark, tmp_path, "qc_whitespace_frag")
    plan = plans.queries()["verdicts_after_repair"](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(" not in plan and plan.count("documents.parquet") + plan.count("Relation [doc_id") <= 2


def test_rates_of_many_large_and_empty_texts(spark, monkeypatch):
    texts = [None, "", "The cat, the CAT" * 3, "x" * 70_000 + " the " * 30_000, "Ké the", "K the", "a I"] * 60
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    lexicon = spark.createDataFrame([("the",), ("k",), (None,)], "word string")
    for least in (1, 2):
        got = sorted(map(tuple, quality.hit_rates(docs, "k", "t", lexicon, least).collect()))
        with monkeypatch.context() as m:
            m.setattr(quality, "SMALL", 1)
            assert got == sorted(map(tuple, quality.hit_rates(docs, "k", "t", lexicon, least).collect()))
        assert len(got) == len(texts) and got[0][1:] == (0, 1.0) and got[4][1:] == (3 - least, 1.0)
