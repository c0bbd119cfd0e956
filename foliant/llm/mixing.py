"""Mixing sources to target weights by Poisson replication.

A source's rate is (its target share x total) / its own size; each document is repeated as often
as the inverse of the Poisson distribution with that mean says at a uniform number hashed from
(seed, doc_id). A mean over SPLIT is cut into equal parts whose draws, at uniform numbers hashed
from (seed, doc_id, part), are added. All copies are then dealt to partitions and ordered by a second hash.

Defined cases: a null source is a source of its own (""); null texts and ids are carried as they
are; a very long text is carried whole, once for each copy; rows equal in doc_id get equal counts; a source without a target weight is dropped only if
weights are given and lack it; an empty table gives no rows; other columns are carried, but
those called copy_no or shuffle_key are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import materialize

TEMPERATURE = 0.5
SEED = "mix-1"
BROADCAST_ROWS = 10_000
SPLIT = 700.0  # exp(-rate) is a normal double up to 708


def uniform(*parts) -> F.Column:
    """A number in (0, 1) from the first 13 hex digits of an MD5."""
    return (F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: float = 1.0) -> DataFrame:
    """source, n, rate. Without weights, a source's target share goes with its size to the power `temperature`."""
    sizes = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("n"))
    if weights is not None:
        wanted = docs.sparkSession.createDataFrame(sorted(weights.items()), "source string, w double")
        sizes = sizes.join(wanted, "source")
    else:
        sizes = sizes.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    sizes = materialize(sizes, "sizes")
    sums = sizes.agg(F.sum("w").alias("ws"), F.sum("n").alias("ns"))
    return sizes.crossJoin(F.broadcast(sums)).select("source", "n", (F.col("w") / F.col("ws") * F.col("ns") * F.lit(float(total)) / F.col("n")).alias("rate"))  # sums is one row


def poisson(u, rate) -> F.Column:
    """The least k whose distribution function exceeds u; the terms up to mean + 12 deviations + 20 leave under 2**-53. For rates up to SPLIT."""
    top = F.ceil(rate + F.sqrt(rate) * 12 + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))

    def step(acc, i):
        p = acc["p"] * rate / i.cast("double")
        done = (acc["c"] > u) | (acc["k"] < i - 1)
        return F.struct(p.alias("p"), F.when(done, acc["c"]).otherwise(acc["c"] + p).alias("c"), F.when(done, acc["k"]).otherwise(i).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda acc: acc["k"])


def draws(seed: str, key, rate) -> F.Column:
    """A Poisson number of mean `rate`: the sum of independent ones of equal means up to SPLIT, each at a uniform number of its own."""
    parts = F.greatest(F.ceil(rate / SPLIT).cast("int"), F.lit(1))
    own = lambda j: F.when(j == 0, uniform(F.lit(seed), F.lit("n"), key)).otherwise(uniform(F.lit(seed), F.lit("n"), key, j.cast("string")))
    us = F.transform(F.sequence(F.lit(0), parts - 1), own)
    return F.aggregate(us, F.lit(0), lambda n, u: n + poisson(u, rate / parts))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, total: float = 1.0, seed: str = SEED) -> DataFrame:
    """docs' columns, source null as it was, and copy_no (from 1) and shuffle_key; partitions and rows in hashed order."""
    rate = materialize(rates(docs, weights, temperature, total).select("source", "rate"), "rates")
    small = rate.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("copy_no", "shuffle_key")])  # whatever their names, they cannot clash
    named = docs.select(row.alias("row"), F.coalesce("source", F.lit("")).alias("source"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"))
    rated = named.join(F.broadcast(rate) if small else rate, "source")
    rated = rated.withColumn("n", draws(seed, F.col("key"), F.col("rate"))).filter("n > 0")
    copies = rated.select("row", "key", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy_no"))
    copies = copies.select("row", "copy_no", F.md5(F.concat_ws("|", F.lit(seed), F.lit("o"), "key", F.col("copy_no").cast("string"))).alias("shuffle_key"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copies.repartition(parts, "shuffle_key").sortWithinPartitions("shuffle_key").select("row.*", "copy_no", "shuffle_key")
