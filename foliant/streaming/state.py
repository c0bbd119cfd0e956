"""Incremental behaviour (STR-1 … STR-7), as batches and as streams; event-time windows (STR-8) are extras."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def todo(work: DataFrame, done: DataFrame, key: list[str], limit: int | None = None) -> DataFrame:
    """STR-1, LIM-3: work not yet logged."""
    rest = work.join(done.select(*key).distinct(), key, "left_anti")
    return rest.limit(limit) if limit is not None else rest


def parsed_log(raw: DataFrame, schema: str) -> DataFrame:
    """STR-1: a log of JSON lines; those that cannot be read are ignored."""
    return raw.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).filter("r is not null").select("r.*").dropna(how="all")


def latest_notes(log: DataFrame) -> DataFrame:
    """STR-2: log: key, text, star, lean, seen, ts. The state of each key: the newest row, gone if it is empty."""
    rows = log.groupBy("key").agg(F.max_by(F.struct("text", "star", "lean", "seen", "ts"), F.struct("ts", "text")).alias("n")).select("key", "n.*")
    empty = (F.coalesce(F.trim("text"), F.lit("")) == "") & ~F.coalesce(F.col("star"), F.lit(False)) & F.col("lean").isNull() & (F.coalesce("seen", F.lit("")) == "")
    return rows.filter(~empty)


def merge_notes(existing: DataFrame, new: DataFrame, replace: bool = False) -> DataFrame:
    """STR-3: a strictly newer ts wins, equal ones leave what is there; replace takes the new set as it is."""
    if replace:
        return latest_notes(new)
    both = existing.withColumn("_old", F.lit(1)).unionByName(new.withColumn("_old", F.lit(0)))
    best = both.groupBy("key").agg(F.max_by(F.struct("text", "star", "lean", "seen", "ts"), F.struct("ts", "_old")).alias("n")).select("key", "n.*")
    return latest_notes(best)


def stale(notes: DataFrame, updated: DataFrame) -> DataFrame:
    """STR-4: notes with is_stale, where the document's updated date is later than what was seen (both ISO dates as text)."""
    return notes.join(updated.select("key", "updated"), "key", "left").withColumn("is_stale", F.coalesce(F.col("updated") > F.coalesce("seen", F.lit("")), F.lit(False)))


def overrides(dates: DataFrame, changes: DataFrame) -> DataFrame:
    """STR-7: dates: key, updated; changes: key, updated (null clears), _seq. The last change of each key holds."""
    last = changes.groupBy("key").agg(F.max_by(F.struct("updated"), "_seq").alias("c"))
    met = dates.join(last, "key", "full").select("key", F.when(F.col("c").isNotNull(), F.col("c.updated")).otherwise(F.col("updated")).alias("updated"))
    return met.filter("updated is not null")


def keep_notes(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """STR-2, STR-3 on a stream: Spark's state store keeps the newest row of each key; each micro-batch writes only the keys that changed, to
    batch=<n>, so a batch that runs again changes nothing. `latest_notes(read_notes(...))` is the state; tombstones stay, so late older rows do not come back."""
    newest = stream.groupBy("key").agg(F.max_by(F.struct("text", "star", "lean", "seen", "ts"), F.struct("ts", "text")).alias("n")).select("key", "n.*")

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return newest.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _parts(spark: SparkSession, path: str) -> tuple[int, list[int]]:
    """The newest whole snapshot (-1 if none) and the whole batches after it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    whole = lambda kind: sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{kind}=") and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, f"{n}/_SUCCESS")))
    newest = max(whole("snapshot"), default=-1)
    return newest, [n for n in whole("batch") if n > newest]


def read_notes(spark: SparkSession, path: str, schema: str = "key string, text string, star boolean, lean string, seen string, ts long") -> DataFrame:
    """The changes that keep_notes wrote: the newest snapshot of `compact_notes` and the batches after it. schema: of the rows where there are none yet."""
    snapshot, batches = _parts(spark, path)
    paths = [f"{path}/snapshot={snapshot}"] * (snapshot >= 0) + [f"{path}/batch={n}" for n in batches]
    return spark.read.parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact_notes(spark: SparkSession, path: str, keep: int | None = None) -> None:
    """STR-3: writes the newest row of each key as a snapshot of all batches so far, then deletes these and older snapshots, so there are never more files than a
    snapshot's and the batches since. keep: empty rows (tombstones) go once they are older than the newest row by this much; a row older still that comes
    late would then be taken for new. A run that breaks off leaves what it found; a batch that the stream writes again after it was compacted is not read twice."""
    snapshot, batches = _parts(spark, path)
    if not batches:
        return
    rows = read_notes(spark, path)
    newest = rows.groupBy("key").agg(F.max_by(F.struct("text", "star", "lean", "seen", "ts"), F.struct("ts", "text")).alias("n")).select("key", "n.*")
    if keep is not None:
        bound = newest.agg(F.max("ts")).first()[0] - keep
        empty = (F.coalesce(F.trim("text"), F.lit("")) == "") & ~F.coalesce(F.col("star"), F.lit(False)) & F.col("lean").isNull() & (F.coalesce("seen", F.lit("")) == "")
        newest = newest.filter(~(empty & (F.col("ts") < bound)))
    newest.write.mode("overwrite").parquet(f"{path}/snapshot={batches[-1]}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(at):
        kind, _, n = f.getPath().getName().partition("=")
        if (kind == "batch" and int(n) <= batches[-1]) or (kind == "snapshot" and int(n) < batches[-1]):
            fs.delete(f.getPath(), True)


def log_results(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """STR-1 on a stream: appended once each, resumed from the checkpoint."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_window(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    """STR-8, an extra: events by window and type, batch or stream."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """STR-8, an extra: sessions of each user."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")
