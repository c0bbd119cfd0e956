"""Spark helpers that several operators use: written intermediate tables and exact running totals."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HOT = 1000
LEAST_FILES, ROWS_A_FILE = 16, 50_000


def lookup(rows: DataFrame, values: DataFrame, key: str, total: int, n: str = "n") -> DataFrame:
    """rows joined with values, one row for each key with `n`, how many of the `total` rows have the key; both are written tables.

    Keys of over 1/HOT of the rows, HOT at most, are broadcast; the rows of these stay where they are, so no task gets all rows of one key.
    """
    many = F.col(n) * HOT > total
    if values.filter(many).isEmpty():
        return rows.join(values, key)
    hot = F.broadcast(values.filter(many))  # HOT rows at most, as their n sum to no more than total
    rest = rows.join(hot.select(key), key, "left_anti").join(values.filter(~many), key)
    return rows.join(hot, key).unionByName(rest)


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: the lineage ends there. rows: about how many there
    will be, if they are small and known; they then go to no more files than it takes."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/foliant/{name}-{uuid.uuid4().hex}"
    (df if rows is None else df.coalesce(max(LEAST_FILES, rows // ROWS_A_FILE))).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of `materialize` that nothing reads any more: what was made of them must be written, not only planned."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.written)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def one_each(rows: DataFrame) -> DataFrame:
    """rows: row (a struct), key, h. The columns of one row for each key, that of the least h; whatever their names, they cannot clash."""
    rank = F.row_number().over(Window.partitionBy("key").orderBy("h"))
    return rows.select("row", rank.alias("rank")).filter("rank = 1").select("row.*")


def lower_ascii(col):
    """Lower-case A-Z only; pure ASCII takes lower(), which does just that."""
    c = F.coalesce(col, F.lit(""))
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def running_totals(df: DataFrame, keys: list[str], amounts: list[str], name: str) -> DataFrame:
    """df in the total order of keys, with before_<amount> (sum of all earlier rows) for each amount.

    Range-partitioned sort, running sums inside each partition, then one total a partition
    (as many rows as there are partitions) added back; no task sees the whole table.
    Rows whose keys are all equal may take either order.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(parts, *[F.col(k).asc_nulls_first() for k in keys]).sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    schema += "".join(f", before_{a} long" for a in amounts) + ", _part int"

    def run(batches):
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), dict.fromkeys(amounts, 0)
        for pdf in batches:
            out = {}
            for a in amounts:
                sums = pdf[a].astype("int64").cumsum()
                out[f"before_{a}"] = sums - pdf[a].astype("int64") + total[a]
                total[a] += int(sums.iloc[-1]) if len(sums) else 0
            yield pdf.assign(**out, _part=pd.Series(part, index=pdf.index, dtype="int32"))

    local = materialize(ranged.mapInPandas(run, schema), name)
    sums = sorted(tuple(r) for r in local.groupBy("_part").agg(*[F.sum(a) for a in amounts]).collect())  # a row for each partition
    if not sums:
        return local.drop("_part")
    rows, total = [], [0] * len(amounts)
    for part, *of in sums:
        rows.append((part, *total))
        total = [x + y for x, y in zip(total, of)]
    base = df.sparkSession.createDataFrame(rows, "_part int" + "".join(f", _base_{a} long" for a in amounts))
    out = local.join(F.broadcast(base), "_part")  # as many rows as partitions
    return out.select(*df.columns, *[(F.col(f"before_{a}") + F.col(f"_base_{a}")).alias(f"before_{a}") for a in amounts])
