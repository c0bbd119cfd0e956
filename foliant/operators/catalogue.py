"""The unified search index (SET-1, SET-5) and its projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("type", "title", "sub", "provisions", "year", "disposition", "url")


def record(df: DataFrame, kind: str, title, url, sub=None, provisions=None, year=None, disposition=None) -> DataFrame:
    """One source as search records; what it lacks is empty. Provisions carry their kind (D12): bare numbers get BCO."""
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    kinds = F.array().cast("array<string>") if provisions is None else F.transform(provisions, lambda p: F.when(p.rlike(r"^\d"), F.concat(F.lit("BCO "), p)).otherwise(p))
    return df.select(
        F.lit(kind).alias("type"), text(title).alias("title"), F.coalesce(text(sub), F.lit("")).alias("sub"), kinds.alias("provisions"),
        F.lit(None).cast("int").alias("year") if year is None else year.cast("int").alias("year"), F.coalesce(text(disposition), F.lit("")).alias("disposition"), text(url).alias("url"))


def union_index(*records: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """SET-1; SET-5: url prefixes in `without` are left out."""
    out = reduce(DataFrame.unionByName, records)
    for prefix in without:
        out = out.filter(~F.col("url").startswith(prefix))
    return out
