"""Audits (AUD-1 … AUD-7): each gives entity, kind, detail; a sound catalogue gives no rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import case_key

LINK = r"\]\(([^)#\s]+)"


def issues(df: DataFrame, kind: str, detail) -> DataFrame:
    return df.select("entity", F.lit(kind).alias("kind"), detail.cast("string").alias("detail"))


def broken_links(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """AUD-1: docs: entity, text; pages: path."""
    links = docs.select("entity", F.explode(F.regexp_extract_all("text", F.lit(LINK), F.lit(1))).alias("path"))
    return issues(links.join(pages.select("path").distinct(), "path", "left_anti"), "broken_link", F.col("path"))


def minutes_instead_of_case(docs: DataFrame, files: DataFrame) -> DataFrame:
    """AUD-2: links to minutes whose text begins with a case that has a page. files: number (without suffix), file."""
    cited = docs.select("entity", F.explode(F.regexp_extract_all("text", F.lit(r"\[((?:19|20)\d{2}-\d+)[^\]]*\]\(\.\./markdown/"), F.lit(1))).alias("raw"))
    return issues(cited.withColumn("number", case_key(F.col("raw"), suffix=False)).join(files, "number"), "minutes_not_case", F.concat_ws(" -> ", "raw", "file"))


def phantom_cases(docs: DataFrame, known: DataFrame) -> DataFrame:
    """AUD-3: numbers that no source knows. known: number."""
    cited = docs.select("entity", F.explode(F.regexp_extract_all("text", F.lit(r"\b((?:19|20)\d{2}-\d{1,3})\b"), F.lit(1))).alias("raw"))
    return issues(cited.withColumn("number", case_key(F.col("raw"), suffix=False)).join(known.select("number").distinct(), "number", "left_anti"), "phantom_case", F.col("raw"))


def old_stars(docs: DataFrame, newest: int = 47) -> DataFrame:
    """AUD-4: starred lines that name only old meetings."""
    rows = docs.select("entity", F.explode(F.split("text", "\n")).alias("line")).filter(F.contains("line", F.lit("⭐")))
    named = F.regexp_extract_all("line", F.lit(r"GA(\d{2})\b"), F.lit(1))
    return issues(rows.filter((F.size(named) > 0) & F.forall(named, lambda n: n.cast("int") <= newest)), "star_recency", F.substring(F.trim("line"), 1, 90))


def missing_sections(docs: DataFrame, sections: list[str], kind: str = "missing_section", head: int | None = None) -> DataFrame:
    """AUD-5; AUD-6 with head, for keys of the front matter."""
    text = F.col("text") if head is None else F.substring("text", 1, head)
    lacking = F.filter(F.array(*[F.when(~F.contains(text, F.lit(s)), F.lit(s)) for s in sections]), lambda x: x.isNotNull())
    return issues(docs.select("entity", F.explode(lacking).alias("s")), kind, F.col("s"))


def wrong_count(docs: DataFrame, pattern: str, expected: int) -> DataFrame:
    """AUD-6: documents whose entries are not as many as they should be."""
    n = F.regexp_count("text", F.lit(pattern))
    return issues(docs.filter(n != expected).withColumn("n", n), "entry_count", F.col("n"))


def all_issues(*found: DataFrame) -> DataFrame:
    """AUD-7."""
    return reduce(DataFrame.unionByName, found)


def gate(found: DataFrame) -> None:
    """AUD-7: an error if there is any issue, with counts by kind."""
    counts = {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}  # a row for each kind
    if counts:
        raise ValueError(f"audit found issues: {counts}")
