"""Whole jobs from the operators: locating missing cases, the hits of a provision, the audit of a catalogue, the search index, the pages of overtures
and cases, the pack of catalogues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import bare, case_key, case_variants, ordinal, or_else
from foliant.operators import audit, catalogue, joins, parsing, quality, repair, search
from foliant.sources import sinks

SECTIONS = ["### Judicial cases", "### Constitutional inquiries", "### Prior overtures", "### RPR exceptions", "### Note"]  # fixed values (AUD-5)
FRONT_MATTER = ["layout: ga53-overture", "title:", "updated:"]  # fixed values (AUD-6)


def hunt(missing: DataFrame, cases: DataFrame, pages: DataFrame, index: DataFrame | None = None, k: int = 4) -> DataFrame:
    """missing: key, title, year; cases: case_id, title, year, _seq; pages: vol, pdf_page, year, ga, text; index: postings of the pages by
    struct(vol, pdf_page), such as `search.write_postings` keeps. Each missing case with its names, its locator, the k best pages and status:
    located (QC-13), relink (JN-6) or not_found."""
    docs = pages.select(F.struct("vol", "pdf_page").alias("doc"), "year", "ga", "text")
    asked = missing.select("key", "title", "year", parsing.parties(F.col("title")).alias("p"), parsing.locator(F.col("title")).alias("locator"))
    asked = asked.select("key", "title", "year", "p.lead", "p.court", "locator", F.col("locator.ga").alias("ga"))
    found = search.locate(search.postings(docs, "doc", "text") if index is None else index, asked, docs, k)
    best = found.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "doc", "score", "lead_hits", "court_hits"))).alias("candidates"))  # k at most
    near = joins.relink(asked, cases.select("case_id", parsing.parties(F.col("title"))["lead"].alias("lead"), "year", "_seq"))
    out = asked.drop("ga").join(best, "key", "left").join(near, "key", "left")
    first = F.get("candidates", F.lit(0))
    strong = quality.strong_location(first["court_hits"], first["lead_hits"])
    return out.withColumn("status", F.when(strong, "located").when(F.col("relink").isNotNull(), "relink").otherwise("not_found"))


def provision_hits(targets: DataFrame, cases: DataFrame, files: DataFrame, cells: dict[str, DataFrame], bodies: DataFrame, titles: DataFrame, blocks: DataFrame) -> DataFrame:
    """targets: targets (a list as text, PAR-6); cases: case_id, number, year, vol, page, cited_as, cited_current; files: file, numbers; cells: by name, rows
    of id and cell; bodies: key, body; titles: key, title; blocks: heading, row. source, id, detail, link of all that cites a target."""
    sections = targets.select(F.explode(parsing.target_sections(F.col("targets"))).alias("section")).distinct()
    own = joins.cases_citing(cases, sections.filter(F.col("section").startswith("BCO"))).select("case_id", F.array_join("matched", ", ").alias("detail"))
    own = own.join(cases.select("case_id", "vol", "page", case_key(F.col("number"), suffix=False).alias("number")), "case_id").join(joins.files_of_cases(files), "number", "left")
    minutes = F.concat(F.lit("../markdown/"), "vol", F.lit(".md#"), F.regexp_extract("vol", "^(ga[0-9]+)", 1), F.lit("-p"), F.col("page").cast("string"))
    link = F.coalesce(F.concat(F.lit("../cases/"), "file", F.lit(".md")), minutes)
    hit = lambda df, source, i, detail, link=None: df.select(F.lit(source).alias("source"), F.col(i).cast("string").alias("id"), detail.alias("detail"), (F.lit(None).cast("string") if link is None else link).alias("link"))
    tables = [hit(joins.cells_citing(rows, "id", "cell", sections, kinds=True).groupBy("id").agg(F.array_sort(F.collect_set("section")).alias("s")), name, "id", F.array_join("s", ", ")) for name, rows in cells.items()]
    found = joins.overtures_citing(bodies, titles, sections, kinds=True)
    named = joins.blocks_of(blocks, sections).select("row", bare(F.col("heading")).alias("detail"))
    return audit.all_issues(hit(own, "case", "case_id", F.col("detail"), link), *tables, hit(found, "overture", "key", F.col("matched_by")), hit(named, "rpr", "row", F.col("detail")))


def catalogue_audit(docs: DataFrame, paths: DataFrame, files: DataFrame, known: DataFrame, rendered: DataFrame, combined: DataFrame, entries: int = 90) -> DataFrame:
    """docs, rendered, combined: entity, text; paths: path; files: file, numbers; known: number. entity, kind, detail of all issues; `audit.gate` makes them an error."""
    judicial = docs.withColumn("text", parsing.section_block(F.col("text"), SECTIONS[0]))
    return audit.all_issues(
        audit.broken_links(docs, paths), audit.minutes_instead_of_case(docs, joins.files_of_cases(files)), audit.phantom_cases(judicial, known), audit.old_stars(docs),
        audit.missing_sections(docs, SECTIONS), audit.missing_sections(rendered, FRONT_MATTER, "frontmatter", 300), audit.wrong_count(combined, r"\n## O", entries),
    )


def search_index(exceptions: DataFrame, inquiries: DataFrame, overtures: DataFrame, files: DataFrame, details: DataFrame, studies: DataFrame) -> DataFrame:
    """exceptions: presbytery, title, sjc, provisions, year, disposition, url; inquiries: the like with type and sub; overtures: title, sub, provisions, year,
    disposition, url; files: file, numbers, title; details: number, provisions, disposition, _seq (JN-19); studies: topic, kind_label, year, file. One record each;
    `sinks.json_array` makes it one array."""
    col = F.col
    of = lambda c: {x: col(x) for x in c}
    plain = of(("provisions", "year", "disposition"))
    reports = F.concat("presbytery", F.lit(" Presbytery"), F.when(col("sjc"), " · ⚖️ SJC").otherwise(""))
    first = F.get("numbers", F.lit(0))
    cases = files.join(joins.search_details(files, details), "file")
    return catalogue.union_index(
        catalogue.record(exceptions, "RPR exception", F.concat_ws(": ", "presbytery", "title"), col("url"), reports, **plain),
        catalogue.record(inquiries.filter(~col("type").eqNullSafe(F.lit("ccb-advice"))), "Constitutional inquiry", col("title"), col("url"), col("sub"), **plain),
        catalogue.record(overtures, "Overture", col("title"), col("url"), col("sub"), **plain),
        catalogue.record(cases, "Judicial case", F.coalesce("title", first), F.concat(F.lit("cases/"), "file", F.lit(".md")), F.concat(F.lit("SJC/CJB case "), first), col("provisions"), F.regexp_extract(first, r"^(\d{4})", 1).try_cast("int"), col("disposition")),
        catalogue.record(studies, "Position paper", col("topic"), F.concat(F.lit("studies/"), "file"), col("kind_label"), year=col("year")),
    )


# Fixed values (SNK-5): the ways back from pages, as their readers know them.
OVERTURES_BACK, CASES_BACK = "[← Overture catalogue](../index/OVERTURES.md)", "[← Judicial case index](../index/CASES.md)"


def bold(name: str, value) -> F.Column:
    """A part of a page's meta line, null if there is nothing to say."""
    return F.concat(F.lit(f"**{name}:** "), F.nullif(F.trim(value), F.lit("")))


def overture_pages(bodies: DataFrame, titles: DataFrame, dispositions: DataFrame, least: int = 40) -> DataFrame:
    """bodies: vol, number, ga, pdf_page, source, body, _seq; titles: vol, number, title, _seq; dispositions: vol, number, disposition, final, ratified, bco (array), note, _seq.
    slug, page, cite (GA51 O7): one page each, for `sinks.write_pages`. Of several bodies the one that reads like an overture counts, then the longest; bodies under `least` letters
    have no page; of several titles or dispositions the last counts."""
    on = ["vol", "_n"]
    text = lambda df: df.withColumn("_n", F.col("number").cast("string"))
    best = joins.keep_best(text(bodies), on, [F.desc(quality.reads_like_motion(F.coalesce("body", F.lit("")))), F.desc(F.length(F.coalesce("body", F.lit("")))), "_seq"])
    best = best.withColumn("body", F.trim(F.coalesce("body", F.lit("")))).filter(F.length("body") >= least).drop("_seq", "number")
    named = joins.keep_last(text(titles).select(*on, "title", "_seq"), on, "_seq").drop("_seq")
    said = joins.keep_last(text(dispositions).drop("number"), on, "_seq").drop("_seq")
    rows = best.join(named, on, "left").join(said, on, "left")
    year, ga = F.regexp_extract("vol", r"_(\d{4})$", 1), F.col("ga").cast("string")
    assembly = F.concat(ordinal(F.col("ga")), F.when(year != "", F.concat(F.lit(" ("), year, F.lit(")"))).otherwise(""))
    meta = [bold("Assembly", assembly), bold("Source", F.col("source")), bold("Disposition", or_else(F.col("final"), F.col("disposition"))), F.when(F.col("ratified"), F.lit("**Ratified**")), bold("BCO", F.array_join("bco", ", "))]
    place = F.when(F.col("pdf_page").isNotNull(), F.concat(F.lit(" p. "), F.col("pdf_page").cast("string"))).otherwise("")
    anchor = F.when(F.col("pdf_page").isNotNull(), F.concat(F.lit("#"), F.substring_index("vol", "_", 1), F.lit("-p"), F.col("pdf_page").cast("string"))).otherwise("")
    source = F.concat(F.lit("*Source: ["), "vol", place, F.lit("](../markdown/"), "vol", F.lit(".md"), anchor, F.lit(")*"))
    note = F.concat(F.lit("> *"), F.nullif(F.trim("note"), F.lit("")), F.lit("*"))
    title = F.concat(F.lit("GA"), ga, F.lit(" O"), "_n", F.lit(" — "), or_else(F.col("title"), F.lit("(untitled overture)")))
    body = F.concat_ws("\n\n", F.lit("---"), note, repair.clause_paragraphs(F.col("body")), F.lit("---"))
    page = sinks.page(title, meta, body, source, OVERTURES_BACK)
    return rows.select(F.concat("vol", F.lit("__o"), "_n").alias("slug"), page.alias("page"), F.concat(F.lit("GA"), ga, F.lit(" O"), "_n").alias("cite"))


CASE_HEADER = r"(?i)^\s*#{0,4}\s*[*_]*\s*((APPEAL|COMPLAINT|PETITION|REVIEW)\s+OF\b|(?:JUDICIAL\s+)?CASE\s+(NO\.?\s*)?\d)"  # fixed value (PAR-12): a line that opens a case


def case_pages(cases: DataFrame, volumes: DataFrame, lines: DataFrame, reach: int = 15, least: int = 40) -> DataFrame:
    """cases: case_id, number, parties, court, ga_ordinal, year, disposition, vote, dissent, cited, provenance, first_page, last_page, _seq; volumes: ga_ordinal, vol; lines: vol,
    line_no, line with page marks. slug, page: one page for each case whose text is found and names it.

    A case's text runs from its first page to the page where the next case of the volume begins, if that is at most `reach` pages on, and is cut at that case's header."""
    first, last = F.col("first_page"), F.coalesce("last_page", "first_page")
    placed = joins.volume_of_case(cases, volumes).filter("vol is not null and first_page is not null")
    placed = joins.next_in(placed, ["vol"], [first, last, "_seq"], ["first_page", "number", "parties"])
    ahead = F.col("next_first_page") - first
    upto = F.when(ahead.between(0, reach), F.greatest(last, "next_first_page")).otherwise(last)
    text = parsing.page_range(lines, placed.select(F.col("case_id").alias("id"), "vol", first.alias("start"), upto.alias("end"))).withColumnRenamed("id", "case_id")
    names = F.slice(parsing.surnames(F.col("next_parties")), 1, 2)
    numbers = F.array_join(case_variants(F.col("next_number")), "|")
    either = F.filter(F.array(F.when(numbers != "", F.concat(F.lit(r"\b(?:"), numbers, F.lit(r")\b"))), F.when(F.size(names) > 0, F.concat(F.lit("^"), F.array_join(F.transform(names, lambda n: F.concat(F.lit("(?=.*"), n, F.lit(")"))), "")))), lambda x: x.isNotNull())
    following = F.when(F.size(either) > 0, F.concat(F.lit("(?i)"), F.array_join(either, "|"))).otherwise("(?!)")
    rows = text.join(placed.select("case_id", following.alias("_next")), "case_id").select("case_id", "_next", F.posexplode(F.split("text", "\n")).alias("_p", "line")).select("case_id", (F.col("_p") + 1).alias("line_no"), "line", "_next")
    body = repair.promote_labels(F.col("text"))
    own = parsing.trim_to_next(rows, "case_id", CASE_HEADER, "_next").select("case_id", body.alias("body")).join(placed, "case_id")
    own = own.filter((F.length("body") >= least) & quality.contains_case(F.col("body"), case_variants(F.col("number")), parsing.person_tokens(F.col("parties")), F.col("provenance")))
    pages = F.when(last != first, F.concat(F.lit(" pp. "), first.cast("string"), F.lit("–"), last.cast("string"))).otherwise(F.concat(F.lit(" p. "), first.cast("string")))
    dash = lambda c: or_else(F.col(c), F.lit("—"))
    meta = [bold("Court", dash("court")), bold("Assembly", F.concat(ordinal(F.col("ga_ordinal")), F.lit(" ("), F.col("year").cast("string"), F.lit(")"))), bold("Disposition", dash("disposition")), bold("Vote", F.col("vote")), F.when(F.col("dissent"), F.lit("**Dissent:** yes")), bold("BCO cited", F.left("cited", F.lit(120)))]
    who = F.coalesce(F.concat(F.lit(" — "), F.nullif(F.trim("parties"), F.lit(""))), F.lit(""))
    title = F.concat(F.lit("Case "), F.coalesce("number", F.concat(F.lit("p"), first.cast("string"))), who)
    source = F.concat(F.lit("*Source: ["), "vol", pages, F.lit("](../markdown/"), "vol", F.lit(".md)*"))
    page = sinks.page(title, meta, F.concat_ws("\n\n", F.lit("---"), "body", F.lit("---")), source, CASES_BACK)
    return own.select(F.regexp_replace("case_id", "[^A-Za-z0-9_.-]", "_").alias("slug"), page.alias("page"))


def catalogue_pack(catalogues: DataFrame, order: list[str], head: str, address: str) -> DataFrame:
    """catalogues: name, text; order: names of those that are packed, in their order (others are left out). ordinal, name, text: the head and then each catalogue
    under a banner with its address; written in the order of ordinal this is one file (SNK-9)."""
    rule = "=" * 78
    wanted = catalogues.sparkSession.createDataFrame(list(enumerate(order, 1)), "ordinal int, name string")
    parts = catalogues.join(F.broadcast(wanted), "name")  # a row for each name asked for
    banner = F.concat(F.lit(f"\n\n{rule}\n# "), "name", F.lit(f"   ({address}/"), "name", F.lit(f")\n{rule}\n\n"), "text")
    first = catalogues.sparkSession.createDataFrame([(0, "", head)], "ordinal int, name string, text string")
    return first.unionByName(parts.select("ordinal", "name", banner.alias("text"))).orderBy("ordinal")
