"""Reconciliation joins and ordered-window helpers (JN-*, WIN-*, AGG-6, AGG-9, SET-*)."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bare, case_key, party_share


def keep_best(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """WIN-6, AGG-6: the first row of each key in this order (best first, then the sequence)."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("_rank = 1").drop("_rank")


def keep_first(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """WIN-5; as an aggregate, so that hot keys are combined before the shuffle."""
    others = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.min_by(F.struct(*others), seq).alias("_b"))
    return best.select(*[F.col(c) if c in key else F.col(f"_b.{c}").alias(c) for c in df.columns])


def keep_last(df: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The last writer wins."""
    others = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*others), seq).alias("_b"))
    return best.select(*[F.col(c) if c in key else F.col(f"_b.{c}").alias(c) for c in df.columns])


def next_in(df: DataFrame, partition: list[str], order: list, columns: list[str]) -> DataFrame:
    """WIN-1, JN-9: next_<column> for each column."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumns({f"next_{c}": F.lead(c).over(w) for c in columns})


def forward_fill(df: DataFrame, partition: list[str], order: list, column, name: str) -> DataFrame:
    """WIN-2."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))


def look_ahead_count(df: DataFrame, partition: list[str], order: list, flag, rows: int, name: str) -> DataFrame:
    """WIN-9: flagged rows among the next `rows`."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(1, rows)
    return df.withColumn(name, F.coalesce(F.sum(F.when(flag, 1).otherwise(0)).over(w), F.lit(0)).cast("long"))


def number_rows(df: DataFrame, partition: list[str], order: list, name: str = "seq") -> DataFrame:
    """WIN-3: from 0 within each partition."""
    return df.withColumn(name, (F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1).cast("long"))


def asof(left: DataFrame, right: DataFrame, key: list[str], at: str, point: str, take: list[str], clamp: bool = False) -> DataFrame:
    """JN-10, JN-11: left's rows with right's columns `take` of the greatest point <= at in the same key.

    Both sides go through one shuffle on the key and one sorted window: no inequality join. clamp: rows before the
    first point take the first.
    """
    cols = [c for c in left.columns]
    a = left.select(*key, F.col(at).alias("_t"), F.lit(1).alias("_side"), F.struct(*cols).alias("_l"), F.lit(None).cast(right.select(F.struct(*take)).schema[0].dataType).alias("_r"))
    b = right.select(*key, F.col(point).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*cols)).schema[0].dataType).alias("_l"), F.struct(*take).alias("_r"))
    w = Window.partitionBy(*key).orderBy("_t", "_side")
    out = a.unionByName(b).withColumn("_v", F.last("_r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    if clamp:
        out = out.withColumn("_v", F.coalesce("_v", F.min_by("_r", F.when(F.col("_side") == 0, F.col("_t"))).over(Window.partitionBy(*key))))
    return out.filter("_side = 1").select(*[F.col(f"_l.{c}").alias(c) for c in cols], *[F.col(f"_v.{c}").alias(c) for c in take])


def first_match_in_list(left: DataFrame, right: DataFrame, id_col: str, array: str, on: list[str], value: str, name: str) -> DataFrame:
    """JN-1: for each row of left, the value of the first element of `array` that right has (with the equal columns `on`; right calls the element `element`)."""
    tried = left.select(id_col, *on, F.posexplode(array).alias("_pos", "element")).join(right.select(*on, "element", value), [*on, "element"])
    found = tried.groupBy(id_col).agg(F.min_by(value, "_pos").alias(name))
    return left.join(found, id_col, "left")


def with_titles(bodies: DataFrame, titles: DataFrame, dispositions: DataFrame, page: bool = False) -> DataFrame:
    """JN-2, JN-3: bodies: vol, number, [pdf_page]; titles: vol, number, title, _seq; dispositions: vol, number, [pdf_page], disposition, _seq.
    bodies with title and disposition by (vol, number) as text, dispositions also by page if asked; the last record of a key wins."""
    on = ["vol", "_n"]
    text = lambda df: df.withColumn("_n", F.col("number").cast("string"))
    last = lambda df, key, value: keep_last(text(df).select(*key, value, "_seq"), key, "_seq").drop("_seq")
    at = [*on, "pdf_page"] if page else on
    return text(bodies).join(last(titles, on, "title"), on, "left").join(last(dispositions, at, "disposition"), at, "left").drop("_n")


def first_in_following(left: DataFrame, right: DataFrame, at: str, steps: int, on: list[str], id_col: str, value: str, name: str) -> DataFrame:
    """JN-13: the value of the first of the positions at..at+steps where right has a row (right calls it `position`)."""
    tried = left.select(id_col, *on, F.explode(F.sequence(F.col(at), F.col(at) + steps)).alias("position")).join(right.select(*on, "position", value), [*on, "position"])
    return left.join(tried.groupBy(id_col).agg(F.min_by(value, "position").alias(name)), id_col, "left")


def page_windows(candidates: DataFrame, before: int = 1, after: int = 7, most: int = 3) -> DataFrame:
    """JN-29: distinct (vol, pdf_page) around the first `most` candidates (case_id, rank, vol, pdf_page)."""
    near = candidates.filter(F.col("rank") <= most).select("vol", F.explode(F.sequence(F.col("pdf_page") - before, F.col("pdf_page") + after)).alias("pdf_page"))
    return near.filter("pdf_page > 0").distinct()


def relink(missing: DataFrame, cases: DataFrame, span: int = 3) -> DataFrame:
    """JN-6: missing: key, lead (array), year; cases: case_id, lead, year, _seq. The first case that shares a name and lies within `span` years (null counts as 0).

    Both meet on the name and on runs of `span` years, so a common name pairs only records of near years."""
    run = lambda y: F.floor(y / max(span, 1))
    a = missing.select("key", F.explode(F.array_distinct("lead")).alias("t"), F.coalesce("year", F.lit(0)).alias("_y"))
    b = cases.select("case_id", "_seq", F.explode(F.array_distinct("lead")).alias("t"), F.coalesce("year", F.lit(0)).alias("_z"))
    a = a.withColumn("_r", F.explode(F.array(*[run(F.col("_y")) + k for k in (-1, 0, 1)])))
    return a.join(b.withColumn("_r", run(F.col("_z"))), ["t", "_r"]).filter(F.abs(F.col("_y") - F.col("_z")) <= span).groupBy("key").agg(F.min_by("case_id", "_seq").alias("relink"))


def merge_found(existing: DataFrame, found: DataFrame, share: float = 0.5, likeness: float | None = None) -> DataFrame:
    """JN-7, JN-8: existing and found: case_id, keys (array), lead, court, _seq. key, action and ids for each found key.

    Same case where at least `share` of the shorter lead is shared and courts do not conflict (both named, nothing in common): skip;
    otherwise the holder of the key is demoted and the found case inserted. likeness: names that are as like as this count in part (FN-21: `party_share`), as where they were misread.
    """
    own = keep_first(existing.select(F.explode("keys").alias("key"), "case_id", "lead", "court", "_seq"), ["key"], "_seq")
    new = found.select(F.explode("keys").alias("key"), F.col("case_id").alias("new_id"), F.col("lead").alias("_lead"), F.col("court").alias("_court"))
    met = new.join(own, "key", "left")
    part = party_share(F.col("lead"), F.col("_lead"), 1.0 if likeness is None else likeness)
    clash = (F.size("court") > 0) & (F.size("_court") > 0) & ~F.arrays_overlap("court", "_court")
    action = F.when(F.col("case_id").isNull(), "insert").when((F.coalesce(part, F.lit(0.0)) >= share) & ~clash, "skip").otherwise("demote_and_insert")
    return met.select("key", "new_id", "case_id", action.alias("action"))


def cases_citing(cases: DataFrame, targets: DataFrame) -> DataFrame:
    """JN-14, SET-3: cases: case_id, year, cited_as, cited_current (null: empty); targets: section. case_id, year, matched (sorted), by year, null as 0."""
    both = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("cited_as", "cited_current")])
    cited = cases.select("case_id", "year", F.explode(F.array_distinct(F.transform(both, bare))).alias("section"))
    met = cited.join(targets.select(bare(F.col("section")).alias("section")).distinct(), "section")
    return met.groupBy("case_id", "year").agg(F.array_sort(F.collect_set("section")).alias("matched")).orderBy(F.coalesce("year", F.lit(0)), "case_id")


def cells_citing(rows: DataFrame, id_col: str, cell: str, targets: DataFrame, kinds: bool = False) -> DataFrame:
    """JN-15: rows whose cell names a target section as a whole number (with kinds, such as 'BCO 9-3'), by extraction and equality instead of a test of every pair."""
    kind = "(?:BCO|RAO) " if kinds else ""
    found = F.array_distinct(F.regexp_extract_all(F.col(cell), F.lit(rf"(?<![\d-])({kind}\d+-\d+)(?![\d-])"), F.lit(1)))
    return rows.select(id_col, F.explode(found).alias("section")).join(targets.select("section").distinct(), "section").select(id_col, "section")


def overtures_citing(bodies: DataFrame, titles: DataFrame, targets: DataFrame, kinds: bool = False) -> DataFrame:
    """JN-16, SET-2: keys found by body or by title, with how."""
    by = lambda df, text, name: cells_citing(df, "key", text, targets, kinds).select("key").distinct().withColumn(name, F.lit(True))
    both = by(bodies, "body", "_b").join(by(titles, "title", "_t"), "key", "full")
    how = F.when(F.col("_b") & F.col("_t"), "body+title").when(F.col("_b"), "body").otherwise("title")
    return both.select("key", how.alias("matched_by"))


def blocks_of(provisions: DataFrame, targets: DataFrame, kinds: bool = True) -> DataFrame:
    """JN-17: blocks by provision heading (heading 'BCO 9-3'); kinds must agree, unless parity with numbers alone is wanted."""
    key = (lambda c: c) if kinds else bare
    return provisions.withColumn("_k", key(F.col("heading"))).join(targets.select(key(F.col("section")).alias("_k")).distinct(), "_k", "left_semi").drop("_k")


def files_of_cases(files: DataFrame) -> DataFrame:
    """JN-18: files: file, numbers (array, aliases). number (normalised, without suffix), file; the last file wins by name."""
    each = files.select("file", F.explode("numbers").alias("n")).select(case_key(F.col("n"), suffix=False).alias("number"), "file").filter("number is not null")
    return each.groupBy("number").agg(F.max("file").alias("file"))


def search_details(files: DataFrame, details: DataFrame) -> DataFrame:
    """JN-19, AGG-9: files: file, numbers; details: number, provisions, disposition, _seq. file, provisions (sorted union), disposition (first that is not blank)."""
    each = files.select("file", F.posexplode("numbers").alias("_p", "n")).withColumn("number", case_key(F.col("n")))
    # one row a number before the join, so that numbers with many details and many files do not multiply
    own = details.select("number", F.explode("provisions").alias("v")).distinct().groupBy("number").agg(F.collect_list(F.struct("v")).alias("_own"))
    said = details.filter(F.trim("disposition") != "").groupBy("number").agg(F.min_by("disposition", F.struct("_seq")).alias("_said"))
    met = each.join(own, "number", "left").join(said, "number", "left")
    provisions = F.array_distinct(F.transform(F.flatten(F.collect_list("_own")), lambda x: x["v"]))
    return met.groupBy("file").agg(F.array_sort(provisions).alias("provisions"), F.min_by("_said", F.when(F.col("_said").isNotNull(), F.col("_p"))).alias("disposition"))


def reconcile(roster: DataFrame, matches: DataFrame, docs: DataFrame, doc_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """JN-21, AGG-12, AUD-8: roster entries without a document, documents without an entry, and one row of coverage."""
    gaps = roster.join(matches.select("alias_id").distinct(), "alias_id", "left_anti")
    extra = docs.join(matches.select(doc_id).distinct(), doc_id, "left_anti")
    counts = roster.agg(F.count("*").alias("entries")).withColumn("k", F.lit(1)).join(gaps.agg(F.count("*").alias("gaps")).withColumn("k", F.lit(1)), "k").join(extra.agg(F.count("*").alias("extra")).withColumn("k", F.lit(1)), "k")
    return gaps, extra, counts.select("entries", (F.col("entries") - F.col("gaps")).alias("located"), "gaps", "extra")


def only_listed(body: DataFrame, pdfs: DataFrame) -> DataFrame:
    """JN-22: pdf rows whose key the body lacks, appended with source pdf_only."""
    rest = pdfs.join(body.select("case_number").distinct(), "case_number", "left_anti")
    return body.withColumn("source", F.lit("body")).unionByName(rest.withColumn("source", F.lit("pdf_only")), allowMissingColumns=True)


def link_cites(docs: DataFrame, doc_id: str, text: str, pages: DataFrame) -> DataFrame:
    """JN-23: 'GA51 O12' becomes a link where pages (cite, path) knows it; cites that are links already and unknown ones stay."""
    found = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(r"(?<!\[)\b(GA\d+ O\d+)\b(?!\])"), F.lit(1)))
    known = docs.select(doc_id, F.explode(found).alias("cite")).join(pages.select("cite", "path"), "cite")
    maps = known.groupBy(doc_id).agg(F.array_sort(F.collect_list(F.struct("cite", "path"))).alias("_m"))
    quoted = lambda m: F.concat(F.lit(r"(?<!\[)\b"), m["cite"], F.lit(r"\b(?!\])"))
    new = F.aggregate("_m", F.col(text), lambda t, m: F.regexp_replace(t, quoted(m), F.concat(F.lit("["), m["cite"], F.lit("]("), m["path"], F.lit(")"))))
    return docs.join(maps, doc_id, "left").withColumn(text, F.coalesce(new, F.col(text))).drop("_m")


def link_catalogue(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """JN-24: rows: vol, number (bare or linked cell); the cell as a link where pages (vol, number, path) has one. Linked cells keep their number (D8)."""
    plain = rows.withColumn("_n", F.regexp_extract("cell", r"^\[?(\d+)", 1).try_cast("int"))
    met = plain.join(pages.select("vol", F.col("number").alias("_n"), "path"), ["vol", "_n"], "left")
    return met.withColumn("cell", F.when(F.col("path").isNotNull(), F.concat(F.lit("["), F.col("_n").cast("string"), F.lit("]("), "path", F.lit(")"))).otherwise(F.col("cell"))).drop("_n", "path")


def ratified(first: DataFrame, later: DataFrame, years: int = 2) -> DataFrame:
    """JN-25: first: id, section, year; later: section, year, note. The earliest later record of the section one to `years` years on."""
    tried = first.withColumn("_y", F.explode(F.sequence(F.col("year") + 1, F.col("year") + years)))
    met = tried.join(later.select("section", F.col("year").alias("_y"), "note"), ["section", "_y"])
    best = met.groupBy("id").agg(F.min("_y").alias("ratified_year"), F.min_by("note", F.struct("_y", "note")).alias("ratification_note"))
    return first.join(best, "id", "left")


def resolve_sections(cites: DataFrame, events: DataFrame, follow: bool = True) -> DataFrame:
    """JN-28: cites: section, year; events: one row with the array `events` in adopted order (broadcast, a fixed list).
    Every event adopted after the year maps a section on; a chapter change is followed (D11) unless follow is off."""
    def step(cur, e):
        hit = F.filter(e["mappings"], lambda m: m["from"] == cur)
        chapter = F.substring_index(cur if follow else F.col("section"), "-", 1)
        applies = (e["adopted_year"] > F.col("year")) & (e["chapter"] == chapter) & (F.size(hit) > 0)
        return F.when(applies, F.get(hit, F.lit(0))["to"]).otherwise(cur)

    return cites.crossJoin(F.broadcast(events)).select("section", "year", F.aggregate("events", F.col("section"), step).alias("current"))  # events is one row


def years_amended(changes: DataFrame, chapter: str) -> DataFrame:
    """AGG-16: changes: year, sections. Years in which a section of the chapter, or the chapter itself (D7), changed."""
    hit = F.exists("sections", lambda s: (F.substring_index(s, "-", 1) == chapter) | s.rlike(rf"(?i)^Chapters?\s+(?:\d+\s*&\s*)?{chapter}\b"))
    return changes.filter(hit).select("year").orderBy("year")


def volume_of_case(cases: DataFrame, volumes: DataFrame) -> DataFrame:
    """JN-30: the prefix of an id such as ga30_2002:x, else the volume of the ordinal."""
    prefix = F.substring_index("case_id", ":", 1)
    met = cases.join(volumes.select("ga_ordinal", F.col("vol").alias("_v")), "ga_ordinal", "left")
    return met.withColumn("vol", F.when(prefix.startswith("ga"), prefix).otherwise(F.col("_v"))).drop("_v")


def one_page_each(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """AUD-9, SET-4: pages: file, numbers, year, text. The best file of each number (nearest at or after the docket's year; earlier ones
    count 50 more; longest in bytes on ties, then by name), and files that are home to no number."""
    each = pages.select("file", F.explode("numbers").alias("number"), "year", F.octet_length("text").alias("size"))
    docket = F.coalesce(F.substring("number", 1, 4).try_cast("int"), F.lit(0))
    away = F.when(F.col("year") >= docket, F.col("year") - docket).otherwise(docket - F.col("year") + 50)
    best = keep_best(each.withColumn("distance", away), ["number"], [F.asc("distance"), F.desc("size"), F.asc("file")])
    return best.select("number", "file", "distance"), pages.select("file").join(best.select("file").distinct(), "file", "left_anti")


def rewrite_sources(rows: DataFrame, points: DataFrame, pattern: str = r"^Source: lines (\d+)-(\d+)$") -> DataFrame:
    """SNK-14, AGG-8: rows: vol, line_no, line. Source lines with line numbers become page labels; `unmapped` marks those without a page."""
    lo, hi = (F.regexp_extract("line", pattern, g).try_cast("int") for g in (1, 2))
    named = rows.withColumns({"_lo": lo, "_hi": hi})
    src = named.filter("_lo is not null")
    a = asof(src, points, ["vol"], "_lo", "line_no", ["page"], clamp=True).withColumnRenamed("page", "_first")
    b = asof(a, points, ["vol"], "_hi", "line_no", ["page"], clamp=True)
    label = F.when(F.col("_first") == F.col("page"), F.concat(F.lit("p. "), F.col("page").cast("string"))).otherwise(F.concat(F.lit("pp. "), F.col("_first").cast("string"), F.lit("–"), F.col("page").cast("string")))
    out = b.select("vol", "line_no", F.when(F.col("page").isNotNull(), F.concat(F.lit("Source: "), label)).otherwise(F.col("line")).alias("line"), F.col("page").isNull().alias("unmapped"))
    return named.filter("_lo is null").select("vol", "line_no", "line", F.lit(False).alias("unmapped")).unionByName(out)


def top_k(df: DataFrame, partition: list[str], order: list, k: int) -> DataFrame:
    """LIM-2: with rank."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).filter(F.col("rank") <= k)


def ordered_distinct(column: str, order: str, separator: str = ", ") -> Column:
    """AGG-10 as an aggregate: values in order, each once, as one text."""
    rows = F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), F.struct(F.col(order).alias("o"), F.col(column).alias("v")))))
    return F.array_join(F.array_distinct(F.transform(rows, lambda x: x["v"])), separator)


def ordered_set_union(column: str) -> Column:
    """AGG-9 as an aggregate."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column))))
