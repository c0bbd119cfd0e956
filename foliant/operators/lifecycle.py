"""Threads of recurring records (JN-26, WIN-10, AGG-14, AGG-15)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

SMALL = 300  # different descriptions of a block that are compared with all others


def identity(df: DataFrame) -> DataFrame:
    """JN-26: thread key: the printed id, else body, dates and provisions; and whether it is printed or inferred."""
    inferred = F.sha2(F.concat_ws("|", F.lower("body"), F.lower(F.regexp_replace(F.coalesce("dates", F.lit("")), r"\W+", "")), F.array_join(F.array_sort(F.transform("provisions", F.lower)), ",")), 256)
    return df.withColumns({"thread": F.coalesce(F.col("id"), inferred), "thread_confidence": F.when(F.col("id").isNotNull(), 1.0).when(F.coalesce("dates", F.lit("")) != "", 0.8).otherwise(0.5)})


def likely_same(df: DataFrame, most: float = 0.3, small: int = SMALL) -> DataFrame:
    """JN-26: pairs of descriptions of one body and provision that differ in at most `most` of the longer one's letters: candidates for one thread. No pair is lost.

    Descriptions that are equal letter by letter are compared once: what is compared are the different texts of a block, and the pairs of their threads are made at the end.
    In blocks of up to `small` texts each is compared with all of like length. In larger ones those are compared that share a segment: a text of which d letters
    may change is cut into d + 1 segments, and one of them stands, at most d letters off, in every shorter text within that distance (`near_pairs`).
    The smaller `most`, the longer the segments and the fewer the comparisons; from a half on, no segment says anything and all are compared.
    The lesser description is `thread`'s. The pairs are as many as they are: copies of one text make a pair each with each.
    """
    rows = df.filter("description is not null and thread is not null").select("thread", "body", "description", F.explode("provisions").alias("provision"))
    rows = rows.select("thread", F.struct("body", "provision").alias("_block"), "description").distinct()
    rows = written(rows.withColumn("_many", F.count("*").over(Window.partitionBy("thread")) > 1), "descriptions")
    each = rows.select("_block", "description").distinct().withColumn("_size", F.greatest(F.length("description"), F.lit(1)))
    each = each.withColumn("_band", band(F.col("_size"), most))
    if 0 < most < 0.5:
        each = written(each.withColumn("_i", F.monotonically_increasing_id()), "texts")
        large = each.groupBy("_block").agg(F.count("*").alias("_n")).filter(F.col("_n") > small).select("_block")
        few, many = each.join(large, "_block", "left_anti"), each.join(large, "_block", "left_semi")
        pairs = all_pairs(few).unionByName(near_pairs(many, most))
    else:
        pairs = all_pairs(each)
    share = F.levenshtein("description", "_d") / F.greatest(F.length("description"), F.length("_d"), F.lit(1))
    near = pairs.withColumn("distance", share).filter(F.col("distance") <= most)
    if most >= 0:
        near = near.unionByName(each.select("_block", "description", F.col("description").alias("_d"), F.lit(0.0).alias("distance")))
    near = written(near, "near")
    theirs = rows.select("_block", F.col("description").alias("_d"), F.col("thread").alias("other"), F.col("_many").alias("_more"))
    out = near.join(rows, ["_block", "description"]).join(theirs, ["_block", "_d"])
    out = out.filter((F.col("thread") != F.col("other")) & ((F.col("description") != F.col("_d")) | (F.col("thread") < F.col("other"))))
    if rows.filter("_many").isEmpty():
        return out.select("thread", "other", "distance")
    # a pair comes twice only if one of the two has several descriptions, bodies or provisions
    again = F.col("_many") | F.col("_more")
    return out.filter(~again).select("thread", "other", "distance").unionByName(out.filter(again).select("thread", "other", "distance").distinct())


def step(most: float) -> float:
    return -math.log(1 - most) * (1 + 1e-9)


def band(size, most: float) -> Column:
    """Lengths by their logarithm: a text and one within the distance are in the same band or in neighbouring ones."""
    return (F.floor(F.log(size.cast("double")) / step(most)) if 0 < most < 1 else size if most <= 0 else F.lit(0)).cast("long")


def all_pairs(each: DataFrame) -> DataFrame:
    """_block, description, _d: each with the others of its block and of like length, once."""
    theirs = each.select(F.col("_block").alias("_b"), F.col("description").alias("_d"), F.explode(F.array(*[F.col("_band") + i for i in (-1, 0, 1)])).alias("_o"))
    met = each.join(theirs, (F.col("_band") == F.col("_o")) & (F.col("_block") == F.col("_b")))
    return met.filter(F.col("description") < F.col("_d")).select("_block", "description", "_d")


def near_pairs(each: DataFrame, most: float) -> DataFrame:
    """The same for those that share a segment: (_i, _j), a longer and a shorter text, and what belongs to them."""
    found = candidates(each, most)
    longer, shorter = each.select("_i", "_block", F.col("description").alias("_a")), each.select(F.col("_i").alias("_j"), F.col("description").alias("_c"))
    met = found.join(longer, "_i").join(shorter, "_j")
    return met.select("_block", F.least("_a", "_c").alias("description"), F.greatest("_a", "_c").alias("_d"))


def candidates(each: DataFrame, most: float) -> DataFrame:
    """each: _i, _block, _band, _size, description. _i, _j: texts of a block, the second not longer, that share a segment of the first at a near place.

    Places are told by their run of as many letters as may change in the band, and segments are listed under the runs beside their own, too.
    """
    size, text = F.col("_size"), F.col("description")
    width = lambda b: (F.floor(F.lit(most) * F.exp((b + 1) * step(most))) + 2).cast("int")
    parts = (F.floor(F.lit(most) * size) + 1).cast("int")
    base, extra = F.floor(F.length(text) / parts).cast("int"), (F.length(text) % parts).cast("int")

    def segment(k):
        at = k * base + F.greatest(k - (parts - extra), F.lit(0))
        return F.struct(F.substr(text, at + 1, base + F.when(k >= parts - extra, 1).otherwise(0)).alias("piece"), F.floor(at / width(F.col("_band"))).cast("int").alias("run"))

    own = each.select("_i", "_block", "_band", "_size", F.explode(F.transform(F.sequence(F.lit(0), parts - 1), segment)).alias("s"))
    own = own.select("_i", "_block", "_band", "_size", "s.piece", F.explode(F.array(*[F.col("s.run") + k for k in (-1, 0, 1)])).alias("run"))
    to = each.select(F.col("_i").alias("_j"), "_block", F.col("_size").alias("_less"), "description", F.explode(F.array(F.col("_band"), F.col("_band") + 1)).alias("_band"))
    least = F.exp(F.col("_band") * step(most)) * (1 - 1e-9)
    shortest = F.floor(least / (F.lit(most) * least + 1)).cast("int")
    lengths = F.filter(F.sequence(F.least(shortest, F.lit(int(1 / most) + 1)), F.lit(int(1 / most) + 1)), lambda n: n <= F.length("description"))
    pieces = F.flatten(F.transform(lengths, lambda n: F.transform(F.sequence(F.lit(0), F.length("description") - n), lambda p: F.struct(F.substr("description", p + 1, n).alias("piece"), F.floor(p / width(F.col("_band"))).cast("int").alias("run")))))
    theirs = to.select("_j", "_block", "_band", "_less", F.explode(F.array_distinct(pieces)).alias("s")).select("_j", "_block", "_band", "_less", "s.piece", "s.run")
    met = own.join(theirs, ["_block", "_band", "piece", "run"]).filter((F.col("_i") != F.col("_j")) & (F.col("_less") <= F.col("_size")) & (F.col("_size") - F.col("_less") <= F.lit(most) * F.col("_size")))
    return met.select("_i", "_j").distinct()


def threads(df: DataFrame, key: list[str], year: str, seq: str, action: str, closed: tuple[str, ...] = ("satisfactory",)) -> DataFrame:
    """WIN-10: key, lifecycle (ordered), final (the last action), first_year, last_year, n, is_open."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(year).alias("year"), F.col(seq).alias("seq"), F.col(action).alias("action"))))
    out = df.groupBy(*key).agg(ordered.alias("lifecycle"))
    return out.select(*key, "lifecycle", F.element_at("lifecycle", -1)["action"].alias("final"), F.element_at("lifecycle", 1)["year"].alias("first_year"), F.element_at("lifecycle", -1)["year"].alias("last_year"),
                      F.size("lifecycle").alias("n"), (~F.element_at("lifecycle", -1)["action"].isin(*closed)).alias("is_open"))


def by_body(threaded: DataFrame, body: str) -> DataFrame:
    """AGG-15."""
    return threaded.groupBy(body).agg(F.count("*").alias("threads"), F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"), F.count_if("is_open").alias("open"))


def by_provision(df: DataFrame, text: str) -> DataFrame:
    """AGG-14: heading 'X · n citation(s)' and the entries."""
    out = df.select(F.explode("provisions").alias("provision"), text).groupBy("provision").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(text)).alias("entries"))
    return out.withColumn("heading", F.concat("provision", F.lit(" · "), F.col("n").cast("string"), F.lit(" citation(s)")))


def counts_by_volume(df: DataFrame, volume: str = "vol") -> DataFrame:
    """AGG-2, AGG-3."""
    kinds = ("raised", "satisfactory", "unsatisfactory")
    return df.groupBy(volume).agg(*[F.count_if(F.col("finding") == k).alias(k) for k in kinds], F.count_distinct("body").alias("bodies"))
