"""Scans (SRC-1 … SRC-15): files to tables, and text to rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import case_key
from ..operators.numbering import before, row_ids

PAGES = "vol string, pdf_page int, printed_page int, text string, char_count int, reocr boolean"
# Entities that the text of a page may have. &amp; is read last, so that &amp;quot; is not read twice.
ENTITIES = {"&nbsp;": " ", "&quot;": '"', "&#146;": "'", "&rsquo;": "'", "&#147;": '"', "&#148;": '"', "&amp;": "&"}


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-1: one object a line; a missing path gives no rows."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def volume_files(spark: SparkSession, pattern: str, schema: str = PAGES) -> DataFrame:
    """SRC-2: files of one volume each; vol from the file's name, file for the order of names."""
    raw = spark.read.schema(schema).json(pattern)
    name = F.col("_metadata.file_name")
    return raw.withColumn("file", name).withColumn("vol", F.regexp_extract(name, r"^([^.]+)", 1))


def json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-3: whole-file JSON; an array gives a row for each element, a missing path none."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def json_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """SRC-3: a file that is one object: key, value."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", f"map<string,{value}>")).alias("key", "value"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4: vol, line_no (from 1), line of whole text files."""
    whole = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1).alias("vol"), "value")
    return lines(whole, "vol", "value")


def lines(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """A row for each line of a text column."""
    return df.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_at", "line")).select(key, (F.col("_at") + 1).alias("line_no"), "line")


def tsv_row(spark: SparkSession, path: str, key: str, columns: int = 5) -> DataFrame:
    """SRC-5: the rows whose first column is key; an error where there are none."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    rows = spark.read.schema(schema).option("quote", "").csv(path, sep="\t").filter(F.col("c0") == key)
    if rows.isEmpty():
        raise LookupError(f"{key} is not in {path}")
    return rows


def with_sequence(df: DataFrame, *order: str) -> DataFrame:
    """SRC-6: _seq, dense numbers from 1: of a scan straight from files in the order of files and rows, whatever the partitions; else in the order of the given columns, equal ones in any."""
    if not order:
        return row_ids(df, "_seq")
    keys = F.struct(*order).alias("_k")
    sizes = before(df.groupBy(keys).agg(F.count("*").alias("_n")), "_k", "_n", "_before").select("_k", "_before")
    own = df.withColumn("_k", keys).withColumn("_i", F.row_number().over(Window.partitionBy("_k").orderBy(F.lit(0))))
    return own.join(sizes, "_k").select(*df.columns, (F.col("_before") + F.col("_i")).alias("_seq"))


def pipe_tables(rows: DataFrame, key: str = "vol") -> DataFrame:
    """SRC-7: key, section, line_no, cells of Markdown table rows in lines; headings set the section; header and rule rows are left out."""
    w = Window.partitionBy(key).orderBy("line_no")
    heading = F.when(F.col("line").rlike("^#+ "), F.regexp_replace("line", "^#+ +", ""))
    bars = F.col("line").rlike(r"^\s*\|.*\|\s*$")
    rule = F.col("line").rlike(r"^\s*\|[\s:|-]+\|\s*$")
    out = rows.withColumns({"section": F.last(heading, ignorenulls=True).over(w), "_next": F.lead("line").over(w)})
    head = F.coalesce(F.col("_next").rlike(r"^\s*\|[\s:|-]+\|\s*$"), F.lit(False))
    body = F.regexp_extract("line", r"^\s*\|(.*)\|\s*$", 1)
    cells = F.transform(F.split(body, r"(?<!\\)\|"), lambda x: F.trim(x))
    return out.filter(bars & ~rule & ~head).select(key, "section", "line_no", cells.alias("cells"))


def visible_text(html, breaks: bool = True) -> Column:
    """SRC-8: scripts and styles dropped, block tags to line breaks, other tags to spaces, entities read, blanks squeezed."""
    h = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>", "")
    if breaks:
        h = F.regexp_replace(h, r"(?i)</?(br|p|tr|li|h[0-9]|div|td)[^>]*>", "\n")
    h = F.regexp_replace(h, "<[^>]+>", " ")
    for name, char in ENTITIES.items():
        h = F.replace(h, F.lit(name), F.lit(char))
    if not breaks:
        return F.trim(F.regexp_replace(h, "[ \t\r\n]+", " "))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(h, "[ \t\r]+", " "), " ?\n ?", "\n"), "^ | $", "")


def links(df: DataFrame, key: str, html: str, pattern: str = r'href="([^"]*)"') -> DataFrame:
    """SRC-9: key, at, href for each link in order. For last-wins lookups take max_by(href, at)."""
    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(pattern), F.lit(1))
    return df.select(key, F.posexplode(found).alias("at", "href"))


def keyed_links(df: DataFrame, html: str, pattern: str = r'href="(cases/((\d{4})-[^"/]*?)\.pdf)"[^>]*>([^<]*)<', order: str | None = None) -> DataFrame:
    """SRC-9: key (case number), url, raw (file name), year and title of the links to case files; of equal keys the last wins: that of the last row by the column order
    (else as they are read), and in it the last."""
    rows = df.select((F.monotonically_increasing_id() if order is None else F.col(order)).alias("_row"), F.posexplode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(pattern), F.lit(0))).alias("_at", "a"))
    part = lambda g: F.regexp_extract("a", pattern, g)
    rows = rows.select(F.struct("_row", "_at").alias("_at"), case_key(part(2)).alias("key"), part(1).alias("url"), part(2).alias("raw"), part(3).cast("int").alias("year"), F.trim(part(4)).alias("title"))
    return rows.groupBy("key").agg(F.max_by(F.struct("url", "raw", "year", "title"), "_at").alias("l")).select("key", "l.*")


def anchors(rows: DataFrame, key: str = "vol", pattern: str = r'<a id="ga\d+-p(\d+)">') -> DataFrame:
    """SRC-13: key, line_no, page of numeric page anchors."""
    page = F.regexp_extract("line", pattern, 1)
    return rows.filter(page != "").select(key, "line_no", page.cast("int").alias("page"))


def events_in_order(df: DataFrame) -> DataFrame:
    """SRC-14: one row, all renumbering events as an array by adopted year (a fixed, short list)."""
    fields = F.struct("adopted_year", "chapter", "ga", "kind", "status", "mappings")
    return df.agg(F.array_sort(F.collect_list(fields)).alias("events"))


def roster_of_year(roster: DataFrame, year: int) -> DataFrame:
    """SRC-15."""
    return roster.filter(F.col("year") == year).select("case_number_raw", "title", "has_pdf")


def recognise(pages: DataFrame, reader: Callable[[str, int], str]) -> DataFrame:
    """SRC-12: vol, pdf_page, status, new_text from a reader given by the caller; its errors become rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for vol, page in zip(pdf["vol"], pdf["pdf_page"]):
                try:
                    rows.append((vol, page, "ok", reader(vol, int(page))))
                except Exception as e:  # noqa: BLE001
                    rows.append((vol, page, f"error: {e}"[:200], None))
            yield pd.DataFrame(rows, columns=["vol", "pdf_page", "status", "new_text"])

    return pages.select("vol", "pdf_page").mapInPandas(run, "vol string, pdf_page int, status string, new_text string")
