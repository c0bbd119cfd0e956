"""Dense numbers, trees of any depth, pages and settings."""

import os

import pytest
from pyspark.sql import functions as F

from foliant.operators import hierarchy, numbering
from foliant.sources import readers, sinks


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_row_ids_do_not_depend_on_partitions(spark, tmp_path, fmt):
    spark.range(5000).select("id", F.repeat(F.lit("x"), F.lit(40)).alias("pad")).repartitionByRange(4, "id").sortWithinPartitions("id").write.format(fmt).save(f"{tmp_path}/t")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "20k", "3k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = readers.with_sequence(spark.read.schema("id long, pad string").format(fmt).load(f"{tmp_path}/t"))
            assert got.columns == ["id", "pad", "_seq"] and got.filter("_seq = id + 1").count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sums_before_each_key(spark):
    rows = [(None, 4)] + [(i, i % 5) for i in range(200)]
    got = {r.k: r.before for r in numbering.before(spark.createDataFrame(rows, "k int, n long").repartition(7), "k", "n").collect()}
    assert got == {k: sum(n for _, n in rows[:i]) for i, (k, _) in enumerate(rows)}
    assert numbering.before(spark.createDataFrame([], "k int, n long"), "k", "n").count() == 0
    twice = readers.with_sequence(spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "k string"), "k").collect()
    assert sorted((r._seq, r.k) for r in twice) == [(1, None), (2, "a"), (3, "b"), (4, "b")]


def test_paths_of_a_deep_chain_and_of_circles(spark):
    chain = [(i, i - 1 if i else None, f"n{i}") for i in range(1000)] + [(2000, None, None), (2001, 2000, "x")]
    got = {r.node_id: (r.level, r.path) for r in hierarchy.paths(spark.createDataFrame(chain, "node_id long, parent_id long, label string")).collect()}
    assert len(got) == 1002 and got[999] == (999, " > ".join(f"n{i}" for i in range(1000))) and got[2001] == (1, " > x")
    for bad in ([(1, 2, "a"), (2, 1, "b"), (3, None, "c")], [(1, 1, "a")], [(1, 9, "a"), (2, None, "b")], [(1, 2, "a"), (2, 3, "b"), (3, 1, "c"), (4, 3, "d"), (5, None, "e")]):
        with pytest.raises(ValueError, match="root"):
            hierarchy.paths(spark.createDataFrame(bad, "node_id long, parent_id long, label string"))
    assert hierarchy.paths(spark.createDataFrame([], "node_id long, parent_id long, label string")).count() == 0


def test_flatten_goes_as_deep_as_the_schema(spark):
    kind = "struct<label:string>"
    for _ in range(6):
        kind = f"struct<label:string,children:array<{kind}>>"
    node = ("leaf",)
    for k in range(6):
        node = (f"l{k}", [node])
    got = hierarchy.flatten(spark.createDataFrame([("v", [node])], f"vol string, parts array<{kind}>"), "parts", fields=("label",))
    assert sorted((r.level, r.seq, r.label) for r in got.collect()) == [(k, k, f"l{5 - k}" if k < 6 else "leaf") for k in range(7)]


def pages(spark, rows):
    return spark.createDataFrame(rows, "slug string, page string")


def test_one_file_for_each_page(spark, tmp_path):
    path = f"{tmp_path}/p"
    sinks.write_pages(pages(spark, [(f"s{i}", f"# {i} é") for i in range(50)] + [("s7", "again"), ("empty", None)]), path)
    assert sorted(os.listdir(path)) == sorted([f"s{i}.md" for i in range(50)] + ["empty.md"])
    assert (tmp_path / "p/s7.md").read_text() == "# 7 é\n\nagain" and (tmp_path / "p/empty.md").read_text() == ""
    (tmp_path / "p/other.txt").write_text("stays")
    sinks.write_pages(pages(spark, [("new", "x")]), path)
    assert sorted(os.listdir(path)) == ["new.md", "other.txt"]
    sinks.write_pages(pages(spark, [("more", "y")]), path, append=True)
    sinks.write_pages(pages(spark, []), f"{tmp_path}/none")
    assert sorted(os.listdir(path)) == ["more.md", "new.md", "other.txt"]


@pytest.mark.parametrize("bad", ["../up", "", ".hidden", "a/b"])
def test_a_failed_task_leaves_no_page(spark, tmp_path, bad):
    path = f"{tmp_path}/p"
    sinks.write_pages(pages(spark, [("old", "x")]), path)
    with pytest.raises(Exception, match="no name for a page"):
        sinks.write_pages(pages(spark, [(f"s{i}", "y") for i in range(20)] + [(bad, "z")]), path)
    assert os.listdir(path) == ["old.md"] and (tmp_path / "p/old.md").read_text() == "x"


def test_settings_survive_a_crash_between(spark):
    name = "foliant_settings"
    for t in (name, f"{name}_next"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    try:
        spark.createDataFrame([("a", "1"), ("b", "1")], "key string, value string").write.saveAsTable(f"{name}_next")  # the old table had been dropped
        sinks.upsert_meta(spark, name, {"b": "2"})
        assert sorted(map(tuple, spark.table(name).collect())) == [("a", "1"), ("b", "2")] and not spark.catalog.tableExists(f"{name}_next")
    finally:
        for t in (name, f"{name}_next"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
