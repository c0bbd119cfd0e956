"""Connected components by alternating large-star and small-star steps, in windows and groupings only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import HOT, materialize


def components(edges: DataFrame) -> DataFrame:
    """edges: a, b of one orderable type. v, root for every vertex with an edge; root is the least vertex of its component."""
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    n = now.count()
    while True:
        up, down, stars = shape(now)
        if stars:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = told(both, max(up, down) * HOT > n, n).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = told(materialize(large, "large", n), True, n) if up * HOT > n else told(large, False, n)
        ends = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        now = materialize(small.select(ends).select("e.*").filter("a <> b").distinct(), "small", n)
    out = now.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
    return materialize(out, "components", n)


def told(rows: DataFrame, crowded: bool, n: int) -> DataFrame:
    """rows (a, b) with m, the least of a and of all its b. Vertices of over a HOTth of n rows get theirs by broadcast: 2 HOT at most."""
    own = F.least("a", F.min("b").over(Window.partitionBy("a"))).alias("m")
    if not crowded:
        return rows.select("a", "b", own)
    hot = rows.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).filter(F.col("n") * HOT > n).select("a", F.least("a", "m").alias("m"))
    met = rows.join(F.broadcast(hot), "a", "left").select("a", "b", "m")
    return met.filter("m is null").select("a", "b", own).unionByName(met.filter("m is not null"))


def shape(edges: DataFrame) -> tuple[int, int, bool]:
    """The most smaller and the most greater neighbours of a vertex, and whether every vertex with a smaller neighbour has
    one only, and no greater ones: then each b is the root of its a."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("v").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    up, down, more = sums.agg(F.max("up"), F.max("down"), F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()
    return up or 0, down or 0, not more
