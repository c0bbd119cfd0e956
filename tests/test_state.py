"""Snapshots of kept notes, and shares of misread names."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as fn
from foliant.streaming import state

KIND = "key string, text string, star boolean, lean string, seen string, ts long"


def put(spark, path, n, rows):
    spark.createDataFrame([(k, t, False, None, "", ts) for k, t, ts in rows], KIND).write.mode("overwrite").parquet(f"{path}/batch={n}")


def now(spark, path):
    return sorted((r.key, r.text, r.ts) for r in state.latest_notes(state.read_notes(spark, path)).collect())


def test_snapshots_replace_batches_and_keep_tombstones(spark, tmp_path):
    path = f"{tmp_path}/n"
    assert now(spark, path) == []
    state.compact_notes(spark, path)
    put(spark, path, 0, [("a", "one", 1), ("b", "two", 2)])
    put(spark, path, 1, [("a", "", 5), ("c", "three", 3)])
    before = now(spark, path)
    state.compact_notes(spark, path)
    assert [p.name for p in (tmp_path / "n").iterdir()] == ["snapshot=1"] and now(spark, path) == before == [("b", "two", 2), ("c", "three", 3)]
    put(spark, path, 1, [("a", "", 5), ("c", "three", 3)])  # the stream writes its last batch again
    put(spark, path, 2, [("a", "late and old", 4), ("b", "new", 9)])
    assert now(spark, path) == [("b", "new", 9), ("c", "three", 3)]
    state.compact_notes(spark, path)
    assert [p.name for p in (tmp_path / "n").iterdir()] == ["snapshot=2"] and now(spark, path) == [("b", "new", 9), ("c", "three", 3)]
    put(spark, path, 3, [("d", "x", 100)])
    state.compact_notes(spark, path, keep=50)  # a's tombstone goes
    assert {r.key for r in state.read_notes(spark, path).collect()} == {"b", "c", "d"}


def test_a_snapshot_that_broke_off_is_not_read(spark, tmp_path):
    path = f"{tmp_path}/n"
    put(spark, path, 0, [("a", "one", 1)])
    put(spark, path, 1, [("b", "two", 2)])
    spark.createDataFrame([], KIND).write.parquet(f"{path}/snapshot=1")
    (tmp_path / "n/snapshot=1/_SUCCESS").unlink()
    assert now(spark, path) == [("a", "one", 1), ("b", "two", 2)]
    state.compact_notes(spark, path)
    assert now(spark, path) == [("a", "one", 1), ("b", "two", 2)] and [p.name for p in (tmp_path / "n").iterdir()] == ["snapshot=1"]


def test_a_stream_restarts_after_a_failure(spark, tmp_path):
    """The second of three batches fails once; after the restart and a snapshot all is as if it had not."""
    for n in range(3):
        spark.createDataFrame([("k", f"v{n}", False, None, "", n), (f"own{n}", "x", False, None, "", n)], KIND).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    bad = stream().withColumn("text", F.when(F.col("ts") == 1, F.raise_error(F.lit("planted"))).otherwise(F.col("text")))
    with pytest.raises(Exception, match="planted|failed"):
        state.keep_notes(bad, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    state.compact_notes(spark, f"{tmp_path}/out")
    state.keep_notes(stream(), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    state.compact_notes(spark, f"{tmp_path}/out")
    assert now(spark, f"{tmp_path}/out") == [("k", "v2", 2), ("own0", "x", 0), ("own1", "x", 1), ("own2", "x", 2)]
    assert len(list((tmp_path / "out").iterdir())) == 1


def like(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        d, last = [i], d
        for j, y in enumerate(b, 1):
            d.append(min(last[j] + 1, d[-1] + 1, last[j - 1] + (x != y)))
    return 1 - d[-1] / max(len(a), len(b), 1)


def best(a, b, least):
    a, b = sorted(set(a)), sorted(set(b))
    if not a or not b:
        return None
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    return max(sum(s for x, y in zip(a, p) if (s := like(x, y)) >= least) for p in itertools.permutations(b, len(a))) / len(a)


def test_party_share_is_the_best_assignment(spark):
    rng = random.Random(5)
    words = ["smith", "smlth", "smyth", "jones", "janes", "ja", "eastern", "eastem", "church", "chwrch", "of", "if"]
    rows = [(i, rng.sample(words, rng.randint(0, 4)), rng.sample(words, rng.randint(0, 5))) for i in range(120)] + [(900, ["a"] * 3, ["a", "b"])]
    frame = spark.createDataFrame(rows, "i int, a array<string>, b array<string>")
    for least in (0.6, 0.8, 1.0):
        got = {r.i: r.s for r in frame.select("i", fn.party_share(F.col("a"), F.col("b"), least).alias("s")).collect()}
        for i, a, b in rows:
            want = best(a, b, least)
            assert got[i] is None if want is None else got[i] == pytest.approx(want), (a, b, least)


def test_party_share_of_long_lists(spark):
    names = [f"name{i}x" * 2 for i in range(12)]
    other = [n.replace("a", "o", 1) for n in names[::-1]]
    got = spark.createDataFrame([(names, other)], "a array<string>, b array<string>").select(fn.party_share(F.col("a"), F.col("b"))).first()[0]
    assert got > 0.85
