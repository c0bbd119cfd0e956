"""Very long texts, repeated rows and empty tables, one operator after the other."""

import hashlib

import pytest
from pyspark.sql import functions as F

from foliant.llm import centroids, exact_dedup, importance, kneser_ney, merkle, mixing, near_dedup, repetition, simhash, structure

LONG = "word " * 300_000 + "é" * 200_000 + "\n" + " ".join(f"w{i}" for i in range(50_000))  # 2.3 MB, one line of 1.7 MB, one word of 400 kB


def test_exact_dedup_of_very_long_texts(docs):
    got = {r.doc_id: r for r in exact_dedup.decide(docs([LONG, LONG.upper().replace("É", "é"), LONG + ".", "x"])).collect()}
    assert got[0].keep_id == got[1].keep_id == 1 and got[0].group_size == 2 and got[2].kept and bytes(got[0].digest) == hashlib.sha256(LONG.encode()).digest()


def test_repetition_of_very_long_texts_and_equal_rows(docs):
    got = {(r.doc_id, r.n_words, r.n_repeat_words, r.kept) for r in repetition.judge(docs([(1, LONG), (1, LONG), (2, "one two"), (None, None)])).collect()}
    assert got == {(1, 350_001, 300_000, False), (2, 2, 0, False), (None, 0, 0, False)} and repetition.judge(docs([(1, LONG), (1, LONG)])).count() == 2
    assert repetition.judge(docs([])).count() == 0


def test_merkle_of_very_long_and_no_pages(spark):
    make = lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string, digest string, n long")
    rows = [(1, "u", LONG, "d", 1), (1, "u", LONG, "d", 1), (2, "v", "x", "d", 1)]
    assert {(r.page_id, r.state) for r in merkle.fixity(make(rows), make([(1, "u", LONG, "d", 1), (1, "u", LONG + "!", "d", 1), (2, "v", "x", "d", 1)])).collect()} == {(1, "same"), (1, "differs"), (2, "same")}
    assert [r.state for r in merkle.fixity(make([]), make(rows[2:])).collect()] == ["extra"] and merkle.fixity(make([]), make([])).count() == 0


def test_model_scores_a_very_long_text(docs):
    got = {r.doc_id: r for r in kneser_ney.train_and_score(docs([(i, LONG if i == 3 else f"word w{i}") for i in range(12)])).collect()}
    assert got[3].n_tokens == 350_002 and got[3].score < 0 and len(got) == 12


def test_mixing_of_very_long_texts_and_none(docs):
    rows = docs([(i, LONG if i < 2 else "x") for i in range(8)])
    assert all(r.n == len(LONG) for r in mixing.mix(rows).filter("doc_id < 2").select(F.length("text").alias("n")).collect()) and mixing.mix(docs([])).count() == 0


def test_near_dedup_simhash_and_classifier_of_very_long_texts(spark, docs):
    rows = docs([LONG, LONG + " end", "other words entirely here now"])
    assert [r.component_id for r in near_dedup.resolve(rows).orderBy("doc_id").collect()] == [0, 0, 2]
    assert [r.component_id for r in simhash.resolve(rows).orderBy("doc_id").collect()] == [0, 0, 2]
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    assert importance.classify(rows, labels).count() == 3


def test_repair_of_very_long_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", LONG + "."), (1, 1, "user", LONG + "."), (1, 2, "assistant", LONG)], "conv_id long, turn long, role string, text string")
    got = structure.repair(structure.plain(rows)).first()
    assert (got.duplicate, got.truncated, got.cost, got.audit) == (1, 1, 7, "KDK")
    made = f"user:{LONG}.\nassistant:{LONG}"
    assert got.repaired_sha256 == hashlib.sha256(made.encode()).hexdigest()


@pytest.mark.parametrize("extra", ["cluster", "was", "distance", "v"])
def test_clusters_of_tables_with_clashing_columns(spark, extra):
    rows = spark.createDataFrame([(i, [float(i % 3)] * 64, "x") for i in range(9)], f"vec_id long, embedding array<float>, `{extra}` string")
    assert centroids.cluster(rows, clusters=3).count() == 9
