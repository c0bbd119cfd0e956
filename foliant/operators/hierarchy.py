"""Trees (TRE-1 … TRE-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .numbering import before
from .scan import carried


def flatten(documents: DataFrame, root: str, key: str = "vol", fields: tuple[str, ...] = ("type", "label", "title")) -> DataFrame:
    """TRE-1, WIN-3: key, path, parent_path, level, fields and seq (preorder within the key) of nested `children` arrays,
    level by level, as deep as the schema goes."""
    now = documents.select(key, F.posexplode(root).alias("_i", "_n")).select(key, F.array("_i").alias("path"), "_n")
    out, level = None, 0
    while True:
        rows = now.select(key, "path", F.lit(level).alias("level"), *[F.col(f"_n.{f}").alias(f) for f in fields])
        out = rows if out is None else out.unionByName(rows)
        kids = next((f for f in now.schema["_n"].dataType.fields if f.name == "children"), None)
        if kids is None or "struct" not in kids.dataType.simpleString():
            break
        now = now.select(key, "path", F.posexplode("_n.children").alias("_i", "_c")).select(key, F.concat("path", F.array("_i")).alias("path"), F.col("_c").alias("_n"))
        level += 1
    out = out.withColumn("parent_path", F.when(F.size("path") > 1, F.slice("path", 1, F.size("path") - 1)))
    return out.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy("path")) - 1)


def with_ids(flat: DataFrame, key: str = "vol") -> DataFrame:
    """WIN-4: flat with node_id, the number of each node over all keys in order (from 1), and parent_id. Keys are numbered by themselves and
    moved on by the sizes of the keys before, which are summed by ranges."""
    moved = before(flat.groupBy(key).agg(F.count("*").alias("_n")), key, "_n", "_before").drop("_n")
    out = flat.join(moved, key).withColumn("node_id", (F.col("_before") + F.col("seq") + 1).cast("long")).drop("_before")
    up = out.select(F.col(key), F.col("path").alias("parent_path"), F.col("node_id").alias("parent_id"))
    return out.join(up, [key, "parent_path"], "left")


def children(nodes: DataFrame, parent: int | None) -> DataFrame:
    """TRE-2."""
    return nodes.filter(F.col("parent_id").isNull() if parent is None else F.col("parent_id") == parent).orderBy("seq")


def paths(nodes: DataFrame, label: str = "label", separator: str = " > ") -> DataFrame:
    """TRE-3: node_id, level, path of labels from the root, for trees of any depth: each node points to an ancestor and holds the labels below it; pointers
    are doubled until all have come to a root, so a tree of depth n takes log2(n) joins.

    An error if nodes never come to one: where parents go in a circle, or one is missing.
    """
    of = nodes.select("node_id", F.col("parent_id").alias("_up"), F.lit(1).cast("long").alias("_n"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("path"))
    now, total = written(of, "paths"), None
    while True:
        counts = now.agg(F.count("*").alias("n"), F.count("_up").alias("open")).first()
        if total is None:
            total, last = counts["n"], counts["open"] + 1
        if counts["n"] < total or counts["open"] >= last:  # a round brings the nearest of them to a root, if they have one
            raise ValueError(f"{total - counts['n'] or counts['open']} nodes do not lead to a root: their parents go in a circle or are not there")
        if not counts["open"]:
            return now.select("node_id", (F.col("_n") - 1).cast("int").alias("level"), "path")
        last = counts["open"]
        up = now.select(F.col("node_id").alias("_up"), F.col("_up").alias("_next"), F.col("_n").alias("_m"), F.col("path").alias("_p"))
        met = now.filter("_up is not null").join(up, "_up").select("node_id", F.col("_next").alias("_up"), (F.col("_n") + F.col("_m")).alias("_n"), F.concat("_p", F.lit(separator), "path").alias("path"))
        now = written(now.filter("_up is null").unionByName(met), "paths")


def outline(nodes: DataFrame, key: str, order: str = "seq", level: str = "level", text: str = "label") -> DataFrame:
    """TRE-4: one indented list for each key."""
    line = F.concat(F.repeat(F.lit("  "), F.col(level)), F.lit("- "), F.col(text))
    return nodes.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), line.alias("l")))), lambda x: x["l"]), "\n").alias("outline"))


def headings(rows: DataFrame, key: str = "vol", deepest: int = 6) -> DataFrame:
    """TRE-5: rows with h1..h<deepest>, the headings in force at each line; a heading ends all deeper ones."""
    level, text = F.length(F.regexp_extract("line", r"^(#{1,6}) ", 1)), F.regexp_replace("line", "^#+ +", "")
    said = {f"h{k}": F.when(level == k, F.struct(text.alias("t"))).when(level.between(1, k - 1), F.struct(F.lit(None).cast("string").alias("t"))) for k in range(1, deepest + 1)}
    out = carried(rows, key, last=said)
    return out.withColumns({h: F.col(h)["t"] for h in said})
