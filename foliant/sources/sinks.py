"""Sinks (SNK-1 … SNK-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .pages import read_pages, write_pages  # noqa: F401

WHOLE = 200_000  # rows of a catalogue that is loaded whole


def load_table(df: DataFrame, name: str, keys: list[str] | None = None) -> int:
    """SNK-1, SNK-2: replaces a table, clustered by keys in place of indexes; its number of rows."""
    ordered = df.repartition(*keys).sortWithinPartitions(*keys) if keys else df
    ordered.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name).count()


def upsert_meta(spark: SparkSession, name: str, values: dict[str, str]) -> None:
    """SNK-3: sets keys of a key-value table, if it exists. The new state is a table of its own before the old one goes, and then takes its name: a crash between
    leaves it as <name>_next, which the next call finishes with."""
    following = f"{name}_next"
    if not spark.catalog.tableExists(name):
        if not spark.catalog.tableExists(following):
            return
        spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    new = spark.createDataFrame(sorted(values.items()), "key string, value string")
    spark.table(name).join(F.broadcast(new), "key", "left_anti").unionByName(new).write.mode("overwrite").saveAsTable(following)  # as many as values
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")


def write_json_lines(df: DataFrame, path: str) -> None:
    """SNK-4."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def page(title, meta, body, source=None, back: str = "[Index](../INDEX.md)") -> Column:
    """SNK-5: a Markdown page: title, meta line of the parts that are there, source, body and the way back."""
    line = F.array_join(F.filter(F.array(*meta), lambda x: x.isNotNull() & (x != "")), " · ")
    return F.concat_ws("\n\n", F.concat(F.lit("# "), title), F.nullif(line, F.lit("")), source if source is not None else F.lit(None).cast("string"), body, F.lit(back))


def json_array(df: DataFrame, order: list[str]) -> DataFrame:
    """SNK-7: one row, a compact array of all rows. For catalogues that a browser loads whole: an error beyond WHOLE rows; larger ones go to write_json_lines."""
    if df.limit(WHOLE + 1).count() > WHOLE:
        raise ValueError(f"more than {WHOLE} rows; use write_json_lines")
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("k"), F.struct("*").alias("v")))), lambda x: x["v"])
    return df.agg(F.to_json(rows, {"ignoreNullFields": "false"}).alias("json"))


def grouped_listing(df: DataFrame, group: str, line, order: list[str]) -> DataFrame:
    """SNK-8: for each group a heading and its lines in order."""
    rows = F.array_sort(F.collect_list(F.struct(*order, line.alias("_line"))))
    return df.groupBy(group).agg(F.concat(F.lit("## "), F.first(group), F.lit("\n"), F.array_join(F.transform(rows, lambda x: x["_line"]), "\n")).alias("text"))


def pack(parts: list[tuple[str, DataFrame]], text: str = "text", order: str | None = None) -> DataFrame:
    """SNK-9: ordinal, name, text: named documents in the given order, those of one name by the column order (else by text); write with one partition for one file."""
    out = None
    for k, (name, df) in enumerate(parts):
        one = df.select(F.lit(k).alias("ordinal"), F.lit(name).alias("name"), F.col(text).alias("text"), F.col(order or text).cast("string" if order is None else dict(df.dtypes)[order]).alias("_o"))
        out = one if out is None else out.unionByName(one)
    return out.orderBy("ordinal", "_o").drop("_o")


def backup_once(df: DataFrame, path: str) -> None:
    """SNK-10: kept only the first time."""
    df.write.mode("ignore").parquet(path)


def with_raw(df: DataFrame, columns: list[str], url: list[str] | None = None) -> DataFrame:
    """SNK-13: picked columns and the whole row as JSON; url: the first of these that is not blank."""
    out = [F.col(c) for c in columns]
    if url:
        out.append(F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in url]).alias("url"))
    return df.select(*out, F.to_json(F.struct("*")).alias("raw"))


def report(df: DataFrame, by: str) -> DataFrame:
    """SNK-12, AGG-1."""
    return df.groupBy(by).count().orderBy(F.desc("count"), by)
