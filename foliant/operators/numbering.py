"""Numbers over whole tables without one task that sees them all (WIN-4, SRC-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def before(sizes: DataFrame, key: str, n: str, name: str = "before") -> DataFrame:
    """sizes: one row for each key, with n. The same with the sum of n over all smaller keys (nulls first): sums inside ranges of keys, and of the ranges, one row a partition."""
    parts = written(sizes.select(key, n).repartitionByRange(F.col(key).asc_nulls_first()).withColumn("_part", F.spark_partition_id()), "ranges")
    totals = sorted(tuple(r) for r in parts.groupBy("_part").agg(F.sum(n)).collect())  # a row for each partition
    base, at = [], 0
    for part, total in totals:
        base.append((part, at))
        at += total
    w = Window.partitionBy("_part").orderBy(F.col(key).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    local = parts.withColumn("_upto", F.sum(n).over(w) - F.col(n))
    starts = parts.sparkSession.createDataFrame(base, "_part int, _base long")
    return local.join(F.broadcast(starts), "_part").select(key, n, (F.col("_upto") + F.col("_base")).alias(name))  # a row for each partition


def row_ids(scan: DataFrame, name: str = "row_id") -> DataFrame:
    """SRC-6: scan (straight from files) with dense numbers from 1 in the order of files' names and of rows in them, whatever the partitions.

    A row's number is its place in its block plus the rows of all blocks before; blocks are counted first, so the rows are scanned twice and not
    shuffled. The driver holds a row for each block.
    """
    # the place of a row in the scan, and the block it comes from
    tagged = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    blocks = tagged.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).collect()
    base, at = [], 1
    for b in sorted(blocks, key=lambda b: (b["_file"], b["_block"])):
        base.append((b["_file"], b["_block"], at - b["_first"]))
        at += b["_n"]
    starts = scan.sparkSession.createDataFrame(base, "_file string, _block long, _move long")
    return tagged.join(F.broadcast(starts), ["_file", "_block"]).select(*scan.columns, (F.col("_at") + F.col("_move")).alias(name))  # a row for each block
