"""Values carried down long ordered texts, segment by segment (WIN-2, WIN-8, WIN-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = 100_000  # numbers of lines that make a segment


def carried(df: DataFrame, key: str, at: str = "line_no", last: dict[str, Column] | None = None, sums: dict[str, Column] | None = None, nexts: dict[str, Column] | None = None, width: int = SEGMENT) -> DataFrame:
    """df with, for each row, of its key in the order of `at` (a whole number, once in a key): the newest value that is not null (last) and the sum (sums)
    up to the row, its own included, and the next row's value (nexts).

    A key may have any number of rows: these are cut into segments of `width` numbers. What a segment does to the value that comes in is
    worked out for each alone (a window over the segment), segments are put in order by one row each, and what came in is added to every row.
    So no task holds a key, and rows are shuffled once, by key and segment. A null key is one of its own.
    """
    last, sums, nexts = last or {}, sums or {}, nexts or {}
    temp = {f"_{kind}_{name}": c for kind, of in (("last", last), ("sum", sums), ("next", nexts)) for name, c in of.items()}
    own = df.withColumns({"_key": F.struct(key), "_segment": F.floor(F.col(at) / width)} | temp)
    w = Window.partitionBy("_key", "_segment").orderBy(at)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    local = own.withColumns({f"_last_{n}": F.last(f"_last_{n}", ignorenulls=True).over(upto) for n in last} | {f"_sum_{n}": F.sum(f"_sum_{n}").over(upto) for n in sums} | {f"_next_{n}": F.lead(F.struct(F.col(f"_next_{n}").alias("v"))).over(w) for n in nexts})
    totals = [F.max_by(f"_last_{n}", F.when(F.col(f"_last_{n}").isNotNull(), F.col(at))).alias(f"_last_{n}") for n in last]
    totals += [F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in sums] + [F.min_by(F.struct(F.col(f"_next_{n}").alias("v")), at).alias(f"_next_{n}") for n in nexts]
    order = Window.partitionBy("_key").orderBy("_segment")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    come = [F.last(f"_last_{n}", ignorenulls=True).over(before).alias(f"_in_last_{n}") for n in last]
    come += [F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_in_sum_{n}") for n in sums] + [F.lead(f"_next_{n}").over(order).alias(f"_in_next_{n}") for n in nexts]
    starts = own.groupBy("_key", "_segment").agg(*totals).select("_key", "_segment", *come)
    out = local.join(starts, ["_key", "_segment"])
    new = {n: F.coalesce(f"_last_{n}", f"_in_last_{n}") for n in last} | {n: F.coalesce(f"_sum_{n}", F.lit(0)) + F.col(f"_in_sum_{n}") for n in sums} | {n: F.coalesce(f"_next_{n}", f"_in_next_{n}")["v"] for n in nexts}
    return out.select(*[new.pop(c).alias(c) if c in new else F.col(c) for c in df.columns], *[c.alias(n) for n, c in new.items()])
