"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries of the text digests name at most `counters` candidates for frequent
digests. Their exact winners and counts are verified over all rows, broadcast (at most
`counters` rows), and frequent copies are settled map-side. All other digests are shuffled.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other and a
group of null ids alone keeps one of them; of rows that are equal in doc_id and text one is
kept; a very long text is whole, one row of one task, and only its digest is shuffled; an empty table gives no rows; other columns are ignored here and carried by `dedup`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import lower_ascii, materialize, one_each

COUNTERS = 1024


def digest(text) -> F.Column:
    return F.unhex(F.sha2(lower_ascii(text), 256))


def _summarise(counters: int):
    """Misra-Gries over batches: add exact counts, then take the (counters+1)-th largest from all."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.Series(dtype="int64")
        for pdf in batches:
            held = held.add(pdf["digest"].map(bytes).value_counts(), fill_value=0)
            if len(held) > counters:
                held = held - np.partition(held.to_numpy(), len(held) - counters - 1)[len(held) - counters - 1]
                held = held[held > 0]
        yield pd.DataFrame({"digest": list(held.index), "n": held.to_numpy("int64")})

    return run


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most `counters` digests, with every one that more than a 1/(counters+1) share of the rows has.

    The partitions' summaries are added up, and the (counters+1)-th largest sum is taken from all of
    them: the merge rule that keeps the Misra-Gries guarantee.
    """
    merged = digests.select("digest").mapInPandas(_summarise(counters), "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    top = merged.orderBy(F.desc("n"), "digest").limit(counters + 1)  # a top-k: counters + 1 rows at most
    least = top.agg(F.when(F.count("*") > counters, F.min("n")).otherwise(F.lit(0)).alias("least"))
    return top.crossJoin(F.broadcast(least)).filter(F.col("n") > F.col("least")).select("digest")  # one row each side: no pairs


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """doc_id, digest, tag, keep_id, group_size, kept: one row for each row of docs."""
    digests = docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest")).withColumn("tag", F.monotonically_increasing_id())
    digests = materialize(digests, "digests")
    hot = materialize(frequent(digests, counters), "frequent")
    best = F.max(F.struct("doc_id", "tag")).alias("best")
    winners = digests.join(F.broadcast(hot), "digest").groupBy("digest").agg(best, F.count("*").alias("group_size"))
    winners = materialize(winners, "winners")  # at most `counters` rows
    marked = digests.join(F.broadcast(winners), "digest", "left")
    group = Window.partitionBy("digest")
    rest = marked.filter(F.col("group_size").isNull()).select("doc_id", "digest", "tag")
    rest = rest.withColumns({"best": F.max(F.struct("doc_id", "tag")).over(group), "group_size": F.count("*").over(group)})
    both = marked.filter(F.col("group_size").isNotNull()).select("doc_id", "digest", "tag", "best", "group_size").unionByName(rest)
    return both.select("doc_id", "digest", "tag", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("tag") == F.col("best.tag")).alias("kept"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay, with all their columns.

    The kept (doc_id, digest) pairs are joined back; rows equal in both are the same document and one stays.
    """
    kept = decide(docs, id_col, text_col, counters).filter("kept").select(F.struct("doc_id", "digest").alias("key"))
    own = docs.select(F.struct("*").alias("row"), F.struct(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest")).alias("key"), F.xxhash64(text_col).alias("h"))
    return one_each(own.join(kept, "key", "left_semi"))
