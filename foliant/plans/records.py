"""More queries over the driver's tables, each with DuckDB SQL: joins of records, aggregates, orders, trees, notes and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import audit, catalogue, hierarchy, joins, lifecycle, search
from ..session import table
from ..sources import readers, sinks
from ..streaming import state
from .queries import WORLD, alias_contains_join, docs, index, passages, query, world

lit, col = F.lit, F.col


def joined(*parts):
    return F.concat(*[lit(p[1:]) if p.startswith("'") else col(p).cast("string") for p in parts])


@query("SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def counts_by_key(spark, d):
    """AGG-1, SNK-12."""
    return sinks.report(table(spark, d, "events"), "event_type")


@query("""SELECT l_suppkey AS vol, count_if(l_returnflag = 'R') AS raised, count_if(l_returnflag = 'A') AS satisfactory, count_if(l_returnflag = 'N') AS unsatisfactory,
count(DISTINCT l_partkey) AS bodies FROM lineitem GROUP BY 1""")
def counts_by_volume(spark, d):
    """AGG-2, AGG-3, with return flags as findings and parts as bodies."""
    finding = F.when(col("l_returnflag") == "R", "raised").when(col("l_returnflag") == "A", "satisfactory").when(col("l_returnflag") == "N", "unsatisfactory")
    return lifecycle.counts_by_volume(table(spark, d, "lineitem").select(col("l_suppkey").alias("vol"), finding.alias("finding"), col("l_partkey").alias("body")))


@query("""SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_linenumber)), ' ') AS pages, CASE WHEN min(l_linenumber) = max(l_linenumber) THEN 'p. ' || min(l_linenumber) ELSE 'pp. ' || min(l_linenumber) || '–' || max(l_linenumber) END AS label FROM lineitem GROUP BY 1""")
def page_labels(spark, d):
    """FN-12, AGG-8, AGG-9: line numbers of an order as the pages of a record."""
    pages = table(spark, d, "lineitem").select("l_orderkey", F.array("l_linenumber").alias("a")).groupBy("l_orderkey").agg(joins.ordered_set_union("a").alias("a"))
    return pages.select("l_orderkey", F.array_join("a", " ").alias("pages"), fn.page_label(col("a")).alias("label"))


@query("SELECT user_id, string_agg(event_type, ', ' ORDER BY f, event_type) AS seen FROM (SELECT user_id, event_type, min(ts) AS f FROM events GROUP BY ALL) GROUP BY 1")
def ordered_distinct_join(spark, d):
    """AGG-10: event types of a user in the order in which they first come."""
    return table(spark, d, "events").groupBy("user_id").agg(joins.ordered_distinct("event_type", "ts").alias("seen"))


@query("""WITH c AS (SELECT c_name, unnest([c_mktsegment, 'NATION ' || c_nationkey]) AS provision FROM customer)
SELECT provision, count(*) AS n, string_agg(c_name, '|' ORDER BY c_name) AS entries, provision || ' · ' || count(*) || ' citation(s)' AS heading FROM c GROUP BY 1""")
def grouped_by_provision(spark, d):
    """AGG-14."""
    c = table(spark, d, "customer").select("c_name", F.array("c_mktsegment", joined("'NATION ", "c_nationkey")).alias("provisions"))
    return lifecycle.by_provision(c, "c_name").withColumn("entries", F.array_join("entries", "|"))


@query("""WITH t AS (SELECT o_orderpriority AS body, o_custkey, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS b, arg_max(o_orderstatus, (year(o_orderdate), o_orderkey)) AS final FROM orders GROUP BY ALL)
SELECT body, count(*) AS threads, min(a) AS first_year, max(b) AS last_year, count_if(final <> 'F') AS "open" FROM t GROUP BY 1""")
def summary_by_body(spark, d):
    """AGG-15, WIN-10: threads of a customer's orders, summed up by priority."""
    o = table(spark, d, "orders").select(col("o_orderpriority").alias("body"), "o_custkey", F.year("o_orderdate").alias("year"), "o_orderkey", "o_orderstatus")
    return lifecycle.by_body(lifecycle.threads(o, ["body", "o_custkey"], "year", "o_orderkey", "o_orderstatus", closed=("F",)), "body")


@query("""SELECT o_orderkey AS year FROM orders WHERE o_custkey % 40 = 12 OR (o_custkey % 3 = 0 AND o_orderkey % 25 = 12)""")
def years_amended(spark, d):
    """AGG-16: sections '12-3' and 'Chapters 5 & 12' both amend chapter 12; '112-3' and '1-12' do not."""
    o = table(spark, d, "orders")
    section = F.concat((col("o_custkey") % 40).cast("string"), lit("-12"))
    chapters = F.when(col("o_custkey") % 3 == 0, F.concat(lit("Chapters 5 & "), (col("o_orderkey") % 25).cast("string"))).otherwise("112-3")
    return joins.years_amended(o.select(col("o_orderkey").alias("year"), F.array(section, chapters).alias("sections")), "12")


@query("""WITH g AS (SELECT count(*) AS n FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(lower(d.text), lower(b.text)))),
e AS (SELECT count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(lower(d.text), lower(b.text)))), a AS (SELECT count(*) AS n FROM benchmark)
SELECT a.n AS entries, a.n - g.n AS located, g.n AS gaps, e.n AS extra FROM a, g, e""")
def roster_coverage(spark, d):
    """AGG-12, AUD-8."""
    return joins.reconcile(passages(spark, d), alias_contains_join(spark, d), docs(spark, d).select("doc_id"), "doc_id")[2]


@query(WORLD + """, g AS (SELECT *, row_number() OVER (ORDER BY vol, seq) AS node_id FROM f)
SELECT vol, label, node_id, CASE level WHEN 0 THEN NULL WHEN 1 THEN max(CASE level WHEN 0 THEN node_id END) OVER w ELSE max(CASE level WHEN 1 THEN node_id END) OVER w END AS parent_id FROM g WINDOW w AS (PARTITION BY vol ORDER BY seq)""")
def tree_global_ids(spark, d):
    """WIN-4, TRE-1: numbers of nodes over all trees, and those of their parents."""
    return hierarchy.with_ids(hierarchy.flatten(world(spark, d), "parts")).select("vol", "label", "node_id", "parent_id")


@query(WORLD + " SELECT vol, label FROM f WHERE level = 0")
def tree_top_level(spark, d):
    """TRE-2."""
    return hierarchy.children(hierarchy.with_ids(hierarchy.flatten(world(spark, d), "parts")), None).select("vol", "label")


@query("""WITH r AS (SELECT n_regionkey AS vol, n_nationkey AS line_no, CASE n_nationkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS level, n_name FROM nation),
a AS (SELECT *, max(CASE WHEN level = 1 THEN line_no END) OVER w AS at1, max(CASE WHEN level = 2 THEN line_no END) OVER w AS at2 FROM r WINDOW w AS (PARTITION BY vol ORDER BY line_no))
SELECT a.vol, a.line_no, x.n_name AS h1, CASE WHEN at1 IS NULL OR at2 > at1 THEN y.n_name END AS h2 FROM a LEFT JOIN nation x ON x.n_nationkey = at1 LEFT JOIN nation y ON y.n_nationkey = at2""")
def headings_in_force(spark, d):
    """TRE-5: nations as lines, every fourth a heading and the one after it a heading below."""
    line = F.concat(F.when(col("n_nationkey") % 4 == 0, "# ").when(col("n_nationkey") % 4 == 1, "## ").otherwise(""), "n_name")
    rows = table(spark, d, "nation").select(col("n_regionkey").alias("vol"), col("n_nationkey").alias("line_no"), line.alias("line"))
    return hierarchy.headings(rows, deepest=2).select("vol", "line_no", "h1", "h2")


@query("""WITH t AS (SELECT c_nationkey AS vol, c_custkey % 50 AS number, arg_max(c_name, c_custkey) AS title FROM customer GROUP BY 1, 2), p AS (SELECT o_custkey % 25 AS vol, o_orderkey % 50 AS number, arg_max(o_orderpriority, o_orderkey) AS disposition FROM orders GROUP BY 1, 2)
SELECT s_suppkey, title, disposition FROM supplier LEFT JOIN t ON t.vol = s_nationkey AND t.number = s_suppkey % 50 LEFT JOIN p ON p.vol = s_nationkey AND p.number = s_suppkey % 50""")
def titles_and_dispositions(spark, d):
    """JN-2, JN-3: both by volume and number, the last record of a key wins."""
    bodies = table(spark, d, "supplier").select("s_suppkey", col("s_nationkey").cast("long").alias("vol"), (col("s_suppkey") % 50).alias("number"))
    titles = table(spark, d, "customer").select(col("c_nationkey").cast("long").alias("vol"), (col("c_custkey") % 50).alias("number"), col("c_name").alias("title"), col("c_custkey").alias("_seq"))
    ends = table(spark, d, "orders").select((col("o_custkey") % 25).alias("vol"), (col("o_orderkey") % 50).alias("number"), col("o_orderpriority").alias("disposition"), col("o_orderkey").alias("_seq"))
    return joins.with_titles(bodies, titles, ends).select("s_suppkey", "title", "disposition")


@query("""WITH c AS (SELECT c_nationkey AS vol, c_custkey % 20 AS element, min(c_name) AS name FROM customer GROUP BY 1, 2), s AS (SELECT s_suppkey, s_nationkey AS vol, unnest([s_suppkey % 7, s_suppkey % 11, s_suppkey % 13]) AS element, unnest([1, 2, 3]) AS k FROM supplier)
SELECT s_suppkey, arg_min(name, k) FILTER (name IS NOT NULL) AS found FROM s LEFT JOIN c USING (vol, element) GROUP BY 1""")
def first_listed_match(spark, d):
    """JN-1: the first of three numbers that a customer of the nation has."""
    left = table(spark, d, "supplier").select("s_suppkey", col("s_nationkey").alias("vol"), F.array(*[col("s_suppkey") % k for k in (7, 11, 13)]).alias("a"))
    right = table(spark, d, "customer").groupBy(col("c_nationkey").alias("vol"), (col("c_custkey") % 20).alias("element")).agg(F.min("c_name").alias("name"))
    return joins.first_match_in_list(left, right, "s_suppkey", "a", ["vol"], "name", "found").select("s_suppkey", "found")


@query("""WITH e AS (SELECT c_custkey % 60 AS key, min(c_custkey) AS case_id FROM customer GROUP BY 1), f AS (SELECT unnest([s_suppkey % 80, s_suppkey % 90]) AS key, s_suppkey AS new_id, s_nationkey AS b FROM supplier),
m AS (SELECT f.*, case_id, [c_mktsegment, (c_nationkey % 3)::VARCHAR] AS lead, c_nationkey % 4 AS court FROM f LEFT JOIN e USING (key) LEFT JOIN customer ON c_custkey = case_id)
SELECT key, new_id, case_id, CASE WHEN case_id IS NULL THEN 'insert' WHEN len(list_intersect(lead, ['BUILDING', (b % 3)::VARCHAR])) >= 1 AND (court = 0 OR b % 4 = 0 OR court = b % 4) THEN 'skip' ELSE 'demote_and_insert' END AS action FROM m""")
def merge_found_cases(spark, d):
    """JN-7, JN-8, FN-21: found cases under two keys; half of the shorter lead in common and no conflict of courts is the same case."""
    names = lambda a, b: F.array(a, (col(b) % 3).cast("string"))
    court = lambda c: F.when(col(c) % 4 == 0, F.array().cast("array<string>")).otherwise(F.array((col(c) % 4).cast("string")))
    existing = table(spark, d, "customer").select(col("c_custkey").alias("case_id"), F.array(col("c_custkey") % 60).alias("keys"), names(col("c_mktsegment"), "c_nationkey").alias("lead"), court("c_nationkey").alias("court"), col("c_custkey").alias("_seq"))
    found = table(spark, d, "supplier").select(col("s_suppkey").alias("case_id"), F.array(col("s_suppkey") % 80, col("s_suppkey") % 90).alias("keys"), names(lit("BUILDING"), "s_nationkey").alias("lead"), court("s_nationkey").alias("court"))
    return joins.merge_found(existing, found)


LIKE = "CASE WHEN 1 - levenshtein({0}, {1}) / greatest(length({0}), length({1}), 1)::DOUBLE >= 0.7::DOUBLE THEN 1 - levenshtein({0}, {1}) / greatest(length({0}), length({1}), 1)::DOUBLE ELSE 0 END"


@query(f"""WITH p AS (SELECT c_custkey, lower(n_name) AS a1, lower(c_mktsegment) AS a2, translate(lower(c_mktsegment), 'io', 'l0') AS b1, CASE WHEN c_custkey % 3 = 0 THEN 'nobody' ELSE replace(lower(n_name), 'n', 'm') END AS b2 FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, greatest({LIKE.format("a1", "b1")} + {LIKE.format("a2", "b2")}, {LIKE.format("a1", "b2")} + {LIKE.format("a2", "b1")}) / 2 AS share FROM p""")
def misread_parties(spark, d):
    """FN-21: parties of two names against the same ones misread and in another order, or one of them another."""
    rows = table(spark, d, "customer").join(table(spark, d, "nation"), col("c_nationkey") == col("n_nationkey"))
    nation, segment = F.lower("n_name"), F.lower("c_mktsegment")
    other = F.array(F.translate(segment, "io", "l0"), F.when(col("c_custkey") % 3 == 0, "nobody").otherwise(F.replace(nation, lit("n"), lit("m"))))
    return rows.select("c_custkey", fn.party_share(F.array(nation, segment), other).alias("share"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '[GA' || (s_suppkey % 10 + 1) || ' O' || s_suppkey || '](p' || s_suppkey || '.md)' ELSE 'GA' || (s_suppkey % 10 + 1) || ' O' || s_suppkey END || ' again, and [GA3 O2](x.md)' AS text FROM supplier""")
def cites_to_links(spark, d):
    """JN-23: cites of even numbers have a page; a cite that is a link stays."""
    text = F.concat(lit("GA"), (col("s_suppkey") % 10 + 1).cast("string"), lit(" O"), col("s_suppkey").cast("string"), lit(" again, and [GA3 O2](x.md)"))
    pages = table(spark, d, "customer").filter("c_custkey % 2 = 0").select(F.concat(lit("GA"), (col("c_custkey") % 10 + 1).cast("string"), lit(" O"), col("c_custkey").cast("string")).alias("cite"), joined("'p", "c_custkey", "'.md").alias("path"))
    return joins.link_cites(table(spark, d, "supplier").select("s_suppkey", text.alias("text")), "s_suppkey", "text", pages)


@query("""SELECT s_suppkey, CASE WHEN EXISTS (SELECT 1 FROM nation WHERE n_nationkey = s_suppkey % 40) THEN '[' || s_suppkey % 40 || '](n' || s_suppkey % 40 || '.md)' WHEN s_suppkey % 2 = 0 THEN (s_suppkey % 40)::VARCHAR ELSE '[' || s_suppkey % 40 || '](old.md)' END AS cell FROM supplier""")
def catalogue_links(spark, d):
    """JN-24: bare and linked cells alike take the page of their number, if there is one."""
    n = (col("s_suppkey") % 40).cast("string")
    rows = table(spark, d, "supplier").select("s_suppkey", lit("v").alias("vol"), F.when(col("s_suppkey") % 2 == 0, n).otherwise(F.concat(lit("["), n, lit("](old.md)"))).alias("cell"))
    pages = table(spark, d, "nation").select(lit("v").alias("vol"), col("n_nationkey").alias("number"), joined("'n", "n_nationkey", "'.md").alias("path"))
    return joins.link_catalogue(rows, pages).select("s_suppkey", "cell")


@query("SELECT c_custkey AS case_number, 'body' AS source FROM customer UNION ALL SELECT o_orderkey, 'pdf_only' FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)")
def listed_only(spark, d):
    """JN-22, SET-4: orders whose number no customer has."""
    return joins.only_listed(table(spark, d, "customer").select(col("c_custkey").alias("case_number")), table(spark, d, "orders").select(col("o_orderkey").alias("case_number")))


NUMBERS = "SELECT p_partkey, 'f' || p_partkey AS file, unnest([(1973 + p_size)::VARCHAR || '-' || lpad((p_partkey % 30)::VARCHAR, 2, '0'), lpad(((73 + p_size) % 100)::VARCHAR, 2, '0') || '-' || (p_partkey % 17)::VARCHAR || 'b', 'none']) AS raw, unnest([0, 1, 2]) AS p, unnest([(1973 + p_size)::VARCHAR || '-' || (p_partkey % 30)::VARCHAR, (1973 + p_size)::VARCHAR || '-' || (p_partkey % 17)::VARCHAR, NULL]) AS number FROM part"


def numbered_files(spark, d):
    p = table(spark, d, "part")
    a = F.concat((lit(1973) + col("p_size")).cast("string"), lit("-"), F.lpad((col("p_partkey") % 30).cast("string"), 2, "0"))
    b = F.concat(F.lpad(((lit(73) + col("p_size")) % 100).cast("string"), 2, "0"), lit("-"), (col("p_partkey") % 17).cast("string"), lit("b"))
    return p.select("p_partkey", joined("'f", "p_partkey").alias("file"), F.array(a, b, lit("none")).alias("numbers"))


@query(f"SELECT number, max(file) AS file FROM ({NUMBERS}) WHERE number IS NOT NULL GROUP BY 1")
def files_by_number(spark, d):
    """JN-18: aliases with two-digit years and letters fall together; the last file by name wins."""
    return joins.files_of_cases(numbered_files(spark, d))


@query(f"""WITH f AS (SELECT file, p, CASE p WHEN 1 THEN number || 'b' ELSE number END AS number FROM ({NUMBERS})),
t AS (SELECT (1973 + p_size) || '-' || (p_partkey % 30) AS number, [p_brand, p_type] AS provisions, CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE p_name END AS disposition, p_partkey AS seq FROM part WHERE p_partkey % 5 = 0),
m AS (SELECT file, p, provisions, nullif(trim(disposition), '') AS s, seq FROM f LEFT JOIN t USING (number))
SELECT file, coalesce(array_to_string(list_sort(list_distinct(flatten(list(provisions) FILTER (provisions IS NOT NULL)))), '|'), '') AS provisions, arg_min(s, p * 1000000 + seq) FILTER (s IS NOT NULL) AS disposition FROM m GROUP BY 1""")
def details_by_file(spark, d):
    """JN-19, AGG-9: the union of provisions over a file's numbers, and the first disposition that is not blank."""
    p = table(spark, d, "part").filter("p_partkey % 5 = 0")
    number = F.concat((lit(1973) + col("p_size")).cast("string"), lit("-"), (col("p_partkey") % 30).cast("string"))
    details = p.select(number.alias("number"), F.array("p_brand", "p_type").alias("provisions"), F.when(col("p_partkey") % 2 == 0, " ").otherwise(col("p_name")).alias("disposition"), col("p_partkey").alias("_seq"))
    return joins.search_details(numbered_files(spark, d).drop("p_partkey"), details).withColumn("provisions", F.array_join("provisions", "|"))


def cited(a, b):
    return F.concat(lit("amend BCO "), (col(a) % 30).cast("string"), lit("-"), (col(b) % 10).cast("string"), lit(" and 101-2-3"))


def nation_targets(spark, d):
    return table(spark, d, "nation").select(F.concat((col("n_nationkey") % 30).cast("string"), lit("-"), (col("n_nationkey") % 7).cast("string")).alias("section"))


@query("SELECT o_orderkey, (o_custkey % 30) || '-' || (o_orderkey % 10) AS section FROM orders WHERE o_custkey % 30 < 25 AND o_orderkey % 10 = o_custkey % 30 % 7")
def catalogue_cells_citing(spark, d):
    """JN-15: cells that name one of the target sections."""
    rows = table(spark, d, "orders").select("o_orderkey", cited("o_custkey", "o_orderkey").alias("cell"))
    return joins.cells_citing(rows, "o_orderkey", "cell", nation_targets(spark, d))


@query("""WITH b AS (SELECT o_orderkey AS key FROM orders WHERE o_custkey % 30 < 25 AND o_orderkey % 10 = o_custkey % 30 % 7), t AS (SELECT o_orderkey AS key FROM orders WHERE o_orderkey % 30 < 25 AND o_custkey % 10 = o_orderkey % 30 % 7)
SELECT key, CASE WHEN b.key IS NOT NULL AND t.key IS NOT NULL THEN 'body+title' WHEN b.key IS NOT NULL THEN 'body' ELSE 'title' END AS matched_by FROM b FULL JOIN t USING (key)""")
def overtures_citing(spark, d):
    """JN-16, SET-2: found by body, by title or by both."""
    o = table(spark, d, "orders")
    return joins.overtures_citing(o.select(col("o_orderkey").alias("key"), cited("o_custkey", "o_orderkey").alias("body")), o.select(col("o_orderkey").alias("key"), cited("o_orderkey", "o_custkey").alias("title")), nation_targets(spark, d))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_custkey % 30 < 25 AND o_orderkey % 10 = o_custkey % 30 % 7")
def blocks_by_heading(spark, d):
    """JN-17: blocks under a target's heading, kinds agreeing."""
    o = table(spark, d, "orders")
    heading = F.concat(F.when(col("o_orderkey") % 2 == 0, "BCO ").otherwise("RAO "), (col("o_custkey") % 30).cast("string"), lit("-"), (col("o_orderkey") % 10).cast("string"))
    targets = nation_targets(spark, d).select(joined("'BCO ", "section").alias("section"))
    return joins.blocks_of(o.select("o_orderkey", heading.alias("heading")), targets).select("o_orderkey")


@query("""SELECT DISTINCT vol, pdf_page FROM (SELECT l_suppkey AS vol, unnest(range(l_partkey % 200 - 1, l_partkey % 200 + 8)) AS pdf_page FROM lineitem WHERE l_linenumber <= 3) WHERE pdf_page > 0""")
def candidate_pages(spark, d):
    """JN-29."""
    c = table(spark, d, "lineitem").select(col("l_orderkey").alias("case_id"), col("l_linenumber").alias("rank"), col("l_suppkey").alias("vol"), (col("l_partkey") % 200).alias("pdf_page"))
    return joins.page_windows(c)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'ga' || (o_custkey % 9) ELSE n_name END AS vol FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 40")
def volumes_of_cases(spark, d):
    """JN-30: the volume named in the id, else that of the ordinal, if there is one."""
    name = F.when(col("o_orderkey") % 3 == 0, F.concat(lit("ga"), (col("o_custkey") % 9).cast("string"), lit(":"), "o_orderkey")).otherwise(joined("'x", "o_orderkey"))
    cases = table(spark, d, "orders").select("o_orderkey", name.alias("case_id"), (col("o_custkey") % 40).alias("ga_ordinal"))
    return joins.volume_of_case(cases, table(spark, d, "nation").select(col("n_nationkey").alias("ga_ordinal"), col("n_name").alias("vol"))).select("o_orderkey", "vol")


@query("""SELECT a.p_partkey AS thread, b.p_partkey AS other, levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name), 1)::DOUBLE AS distance FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey
AND (a.p_name, a.p_partkey) < (b.p_name, b.p_partkey) WHERE levenshtein(a.p_name, b.p_name) / greatest(length(a.p_name), length(b.p_name), 1)::DOUBLE <= 0.3::DOUBLE""")
def likely_same_records(spark, d):
    """JN-26: part names of one brand and type that differ in three letters of ten at most."""
    return lifecycle.likely_same(table(spark, d, "part").select(col("p_partkey").alias("thread"), col("p_brand").alias("body"), F.array("p_type").alias("provisions"), col("p_name").alias("description")))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'id' || c_custkey % 100 ELSE sha256(lower(c_mktsegment) || '|' || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'march' || c_nationkey || '1998' END || '|' || CASE WHEN c_nationkey < 5 THEN 'bco 1-1,rao 2-2' ELSE 'bco 1-1' END) END AS thread,
CASE WHEN c_custkey % 4 = 0 THEN 1.0 WHEN c_custkey % 3 <> 0 THEN 0.8 ELSE 0.5 END::DOUBLE AS thread_confidence FROM customer""")
def thread_identity(spark, d):
    """JN-26, FN-19: the printed id, else a digest of body, dates and provisions."""
    c = table(spark, d, "customer")
    dates = F.when(col("c_custkey") % 3 != 0, F.concat(lit("March "), "c_nationkey", lit(", 1998")))
    rows = c.select("c_custkey", F.when(col("c_custkey") % 4 == 0, F.concat(lit("id"), (col("c_custkey") % 100).cast("string"))).alias("id"), col("c_mktsegment").alias("body"), dates.alias("dates"),
                    F.when(col("c_nationkey") < 5, F.array(lit("RAO 2-2"), lit("BCO 1-1"))).otherwise(F.array(lit("BCO 1-1"))).alias("provisions"))
    return lifecycle.identity(rows).select("c_custkey", "thread", col("thread_confidence").cast("double").alias("thread_confidence"))


@query("SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)::INT AS rank FROM customer QUALIFY rank <= 3")
def top_three(spark, d):
    """LIM-2."""
    return joins.top_k(table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal"), ["c_nationkey"], [F.desc("c_acctbal"), "c_custkey"], 3).select("c_custkey", "c_nationkey", "rank")


@query("""SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey::VARCHAR) - 1 AS by_text, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS by_number,
row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderkey % 5 = 0 THEN 99 ELSE o_orderkey % 120 END, o_orderkey) - 1 AS nulls_at_99 FROM orders""")
def orders_of_numbers(spark, d):
    """SRT-2 to SRT-5, WIN-3: '10' before '2', O2 before O10, and nulls where 99 would stand."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", joined("'O", "o_orderkey").alias("id"), F.when(col("o_orderkey") % 5 != 0, col("o_orderkey") % 120).alias("n"))
    o = joins.number_rows(o, ["o_custkey"], [fn.string_key(col("o_orderkey"))], "by_text")
    o = joins.number_rows(o, ["o_custkey"], [fn.natural_key(col("id"))], "by_number")
    return joins.number_rows(o, ["o_custkey"], [fn.null_as(col("n"), 99), "o_orderkey"], "nulls_at_99").select("o_orderkey", "by_text", "by_number", "nulls_at_99")


@query("""SELECT o_custkey AS key, '1998-01-' || lpad((o_custkey % 28 + 1)::VARCHAR, 2, '0') AS seen, coalesce(o_custkey IN (SELECT c_custkey FROM customer) AND (o_custkey % 7 = 0 OR o_custkey % 28 + 1 < 15), false) AS is_stale FROM (SELECT DISTINCT o_custkey FROM orders)""")
def stale_notes(spark, d):
    """STR-4: notes seen before their document's date; every seventh document is a year younger."""
    day = lambda c: F.concat(lit("1998-01-"), F.lpad((c % 28 + 1).cast("string"), 2, "0"))
    notes = table(spark, d, "orders").select(col("o_custkey").alias("key")).distinct().withColumn("seen", day(col("key")))
    updated = table(spark, d, "customer").select(col("c_custkey").alias("key"), F.when(col("c_custkey") % 7 == 0, "1999-01-01").otherwise("1998-01-15").alias("updated"))
    return state.stale(notes, updated).select("key", "seen", "is_stale")


@query("""WITH c AS (SELECT o_custkey AS key, arg_max({'u': CASE WHEN o_orderstatus = 'O' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END}, o_orderkey) AS c FROM orders WHERE o_orderkey % 4 = 0 GROUP BY 1)
SELECT key, updated FROM (SELECT coalesce(c.key, c_custkey) AS key, CASE WHEN c.key IS NOT NULL THEN c.c.u ELSE '1990-01-01' END AS updated FROM customer FULL JOIN c ON c.key = c_custkey) WHERE updated IS NOT NULL""")
def date_overrides(spark, d):
    """STR-7: the last change of a key sets or clears its date."""
    dates = table(spark, d, "customer").select(col("c_custkey").alias("key"), lit("1990-01-01").alias("updated"))
    changes = table(spark, d, "orders").filter("o_orderkey % 4 = 0").select(col("o_custkey").alias("key"), F.when(col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd")).alias("updated"), col("o_orderkey").alias("_seq"))
    return state.overrides(dates, changes)


@query("""WITH o AS (SELECT o_custkey AS key, 'n' || max(o_orderkey) AS text, max(o_orderkey) AS ts FROM orders GROUP BY 1), c AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS text, 7000 AS ts FROM customer)
SELECT key, CASE WHEN c.key IS NULL OR o.ts >= c.ts THEN o.text ELSE c.text END AS text FROM o FULL JOIN c USING (key) WHERE CASE WHEN c.key IS NULL OR o.ts >= c.ts THEN o.text ELSE c.text END <> ''""")
def notes_merge(spark, d):
    """STR-3, STR-2: an import takes over where it is strictly newer; empty notes are gone."""
    note = lambda df, text, ts: df.select("key", text.alias("text"), lit(False).alias("star"), lit(None).cast("string").alias("lean"), lit("").alias("seen"), ts.cast("long").alias("ts"))
    old = table(spark, d, "orders").groupBy(col("o_custkey").alias("key")).agg(F.max("o_orderkey").alias("m"))
    new = table(spark, d, "customer").select(col("c_custkey").alias("key"), "c_name")
    return state.merge_notes(note(old, F.concat(lit("n"), "m"), col("m")), note(new, F.when(col("key") % 5 == 0, "").otherwise(col("c_name")), lit(7000))).select("key", "text")


@query("""SELECT n, count(*) AS rows FROM (SELECT json_extract(props, '$.k')::BIGINT AS n FROM events WHERE event_id % 10 <> 3) WHERE n IS NOT NULL GROUP BY 1""")
def log_of_json_lines(spark, d):
    """STR-1, FN-16: lines that cannot be read (every tenth is cut short) are ignored."""
    raw = table(spark, d, "events").select(F.when(col("event_id") % 10 == 3, F.substring("props", 1, 3)).otherwise(col("props")).alias("value"))
    return state.parsed_log(raw, "k bigint").groupBy(col("k").alias("n")).agg(F.count("*").alias("rows"))


@query("""SELECT '[' || string_agg('{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS json FROM nation""")
def compact_json(spark, d):
    """SNK-7."""
    return sinks.json_array(table(spark, d, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS url, '{"c_custkey":' || c_custkey || ',"a":"' || CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE ' ' END || '","b":"' || c_mktsegment || '"}' AS raw FROM customer""")
def columns_with_raw(spark, d):
    """SNK-13: picked columns, the first url that is not blank, and the row as JSON."""
    c = table(spark, d, "customer").select("c_custkey", F.when(col("c_custkey") % 2 == 0, col("c_name")).otherwise(" ").alias("a"), col("c_mktsegment").alias("b"))
    return sinks.with_raw(c, ["c_custkey"], ["a", "b"])


@query("""SELECT r_name, '## ' || r_name || chr(10) || string_agg('- ' || n_name, chr(10) ORDER BY n_nationkey) AS text FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1""")
def listing_by_region(spark, d):
    """SNK-8."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), col("n_regionkey") == col("r_regionkey"))
    return sinks.grouped_listing(n, "r_name", F.concat(lit("- "), "n_name"), ["n_nationkey"])


@query("""SELECT s_suppkey, '# ' || s_name || chr(10) || chr(10) || n_name || CASE WHEN s_suppkey % 2 = 0 THEN ' · even' ELSE '' END || chr(10) || chr(10) || 'Balance ' || floor(s_acctbal)::BIGINT || chr(10) || chr(10) || '[Index](../INDEX.md)' AS page FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def entity_pages(spark, d):
    """SNK-5: a page for each supplier; parts of the meta line that are null are left out."""
    s = table(spark, d, "supplier").join(table(spark, d, "nation"), col("s_nationkey") == col("n_nationkey"))
    body = F.concat(lit("Balance "), F.floor("s_acctbal").cast("string"))
    return s.select("s_suppkey", sinks.page(col("s_name"), [col("n_name"), F.when(col("s_suppkey") % 2 == 0, "even")], body).alias("page"))


@query("""SELECT 0 AS ordinal, 'regions' AS name, r_name AS text FROM region UNION ALL SELECT 1, 'nations', n_name FROM nation""")
def pack_of_parts(spark, d):
    """SNK-9."""
    n = table(spark, d, "nation").select(col("n_name").alias("text"), "n_nationkey")
    return sinks.pack([("regions", table(spark, d, "region").select(col("r_name").alias("text"))), ("nations", n)])


@query("SELECT c_name AS title FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 12 AND c_name LIKE '%7%'")
def index_browse(spark, d):
    """FTS-8, SET-1: the index by type, provision and a part of the title."""
    c, s = table(spark, d, "customer"), table(spark, d, "supplier")
    kind = F.when(col("c_nationkey") < 12, "1-1").otherwise("RAO 2-2")
    both = catalogue.union_index(catalogue.record(c.filter("c_mktsegment = 'BUILDING'"), "case", col("c_name"), col("c_custkey"), provisions=F.array(kind)), catalogue.record(s, "body", col("s_name"), col("s_suppkey")))
    return search.browse(both, "case", "BCO 1-1", "7").select("title")


@query(r"SELECT doc_id, source FROM documents WHERE regexp_matches(lower(text), '(^|[^\p{L}\p{N}])license([^\p{L}\p{N}]|$)')")
def search_base_rows(spark, d):
    """JN-4: the documents that a search has found."""
    return search.base_rows(search.search(index(spark, d), "license"), docs(spark, d), "doc_id").select("doc_id", "source")


@query("""SELECT o_orderkey AS entity, 'phantom_case' AS kind, '19' || (90 + o_custkey % 10) || '-' || lpad((o_orderkey % 40)::VARCHAR, 2, '0') AS detail FROM orders WHERE NOT (o_custkey % 10 < 5 AND o_orderkey % 40 < 25)""")
def phantom_cases(spark, d):
    """AUD-3: cited numbers that no nation's list has, padded or not."""
    raw = F.concat(lit("see 19"), (lit(90) + col("o_custkey") % 10).cast("string"), lit("-"), F.lpad((col("o_orderkey") % 40).cast("string"), 2, "0"), lit(" above"))
    known = table(spark, d, "nation").select(F.explode(F.transform(F.sequence(lit(1990), lit(1994)), lambda y: F.concat(y.cast("string"), lit("-"), col("n_nationkey").cast("string")))).alias("number"))
    return audit.phantom_cases(table(spark, d, "orders").select(col("o_orderkey").alias("entity"), raw.alias("text")), known)


@query("""SELECT c_custkey AS entity, 'minutes_not_case' AS kind, '1990-' || lpad((c_custkey % 60)::VARCHAR, 2, '0') || ' -> ' || n_name AS detail FROM customer JOIN nation ON n_nationkey = c_custkey % 60""")
def minutes_for_cases(spark, d):
    """AUD-2: links to minutes although the case has a page."""
    text = F.concat(lit("[1990-"), F.lpad((col("c_custkey") % 60).cast("string"), 2, "0"), lit(" A v. B](../markdown/ga.md)"))
    files = table(spark, d, "nation").select(F.concat(lit("1990-"), "n_nationkey").alias("number"), col("n_name").alias("file"))
    return audit.minutes_instead_of_case(table(spark, d, "customer").select(col("c_custkey").alias("entity"), text.alias("text")), files)


@query("""SELECT c_custkey AS entity, 'star_recency' AS kind, '⭐ GA' || (10 + c_nationkey) || ' and GA' || (30 + c_nationkey) AS detail FROM customer WHERE c_nationkey <= 17 AND c_custkey % 2 = 0""")
def old_stars(spark, d):
    """AUD-4: starred lines that name old meetings only."""
    line = F.concat(F.when(col("c_custkey") % 2 == 0, "⭐ ").otherwise("- "), lit("GA"), (lit(10) + col("c_nationkey")).cast("string"), lit(" and GA"), (lit(30) + col("c_nationkey")).cast("string"))
    return audit.old_stars(table(spark, d, "customer").select(col("c_custkey").alias("entity"), F.concat(lit("# head\n"), line, lit("\nGA60")).alias("text")))


@query("""SELECT doc_id AS entity, 'front_matter' AS kind, 'a' AS detail FROM documents WHERE NOT contains(substr(text, 1, 300), 'a') UNION ALL SELECT doc_id, 'front_matter', 'www.' FROM documents WHERE NOT contains(substr(text, 1, 300), 'www.')
UNION ALL SELECT doc_id, 'entry_count', (len(string_split(text, chr(10))) - 1)::VARCHAR FROM documents WHERE len(string_split(text, chr(10))) <> 3""")
def front_matter_and_counts(spark, d):
    """AUD-6, AUD-7: what the first 300 characters lack, and documents of other than two line ends."""
    t = docs(spark, d).select(col("doc_id").alias("entity"), "text")
    return audit.all_issues(audit.missing_sections(t, ["a", "www."], "front_matter", head=300), audit.wrong_count(t, "\n", 2))


@query("""WITH a AS (SELECT n_regionkey AS vol, n_nationkey AS line_no, n_nationkey * 3 AS page FROM nation WHERE n_nationkey % 4 = 1), s AS (SELECT s_suppkey, s_nationkey % 5 AS vol, s_nationkey AS lo, s_nationkey + s_suppkey % 6 AS hi FROM supplier),
p AS (SELECT s.*, coalesce((SELECT arg_max(page, line_no) FROM a WHERE a.vol = s.vol AND line_no <= lo), (SELECT arg_min(page, line_no) FROM a WHERE a.vol = s.vol)) AS f, coalesce((SELECT arg_max(page, line_no) FROM a WHERE a.vol = s.vol AND line_no <= hi), (SELECT arg_min(page, line_no) FROM a WHERE a.vol = s.vol)) AS t FROM s)
SELECT s_suppkey AS line_no, CASE WHEN f IS NULL THEN 'Source: lines ' || lo || '-' || hi WHEN f = t THEN 'Source: p. ' || f ELSE 'Source: pp. ' || f || '–' || t END AS line, f IS NULL AS unmapped FROM p""")
def sources_to_pages(spark, d):
    """SRC-13, SNK-14, JN-10, AGG-8: source lines become page labels by the anchors before their ends."""
    marks = table(spark, d, "nation").select(col("n_regionkey").alias("vol"), col("n_nationkey").alias("line_no"), F.when(col("n_nationkey") % 4 == 1, F.concat(lit('<a id="ga1-p'), (col("n_nationkey") * 3).cast("string"), lit('">'))).otherwise("text").alias("line"))
    rows = table(spark, d, "supplier").select((col("s_nationkey") % 5).alias("vol"), col("s_suppkey").alias("line_no"), F.concat(lit("Source: lines "), "s_nationkey", lit("-"), (col("s_nationkey") + col("s_suppkey") % 6).cast("string")).alias("line"))
    return joins.rewrite_sources(rows, readers.anchors(marks)).select("line_no", "line", "unmapped")


@query("SELECT '1993-' || o_orderkey AS case_number_raw, o_orderpriority AS title, o_orderstatus = 'F' AS has_pdf FROM orders WHERE year(o_orderdate) = 1997")
def roster_of_year(spark, d):
    """SRC-15."""
    return readers.roster_of_year(table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), joined("'1993-", "o_orderkey").alias("case_number_raw"), col("o_orderpriority").alias("title"), (col("o_orderstatus") == "F").alias("has_pdf")), 1997)


@query("""WITH l AS (SELECT n_regionkey AS r, n_nationkey % 3 AS k, max(n_nationkey) AS n FROM nation GROUP BY ALL)
SELECT (1980 + r) || '-' || k AS key, 'cases/' || (1980 + r) || '-0' || k || '_x' || n || '.pdf' AS url, (1980 + r) || '-0' || k || '_x' || n AS raw, 1980 + r AS year, 'NATION_' || n AS title FROM l""")
def links_last_wins(spark, d):
    """SRC-9: links to case files, a listing a region; of equal numbers the last wins."""
    name = F.concat((lit(1980) + col("n_regionkey")).cast("string"), lit("-0"), (col("n_nationkey") % 3).cast("string"), lit("_x"), col("n_nationkey").cast("string"))
    link = F.struct("n_nationkey", F.concat(lit('<a href="cases/'), name, lit('.pdf">'), "n_name", lit(" </a>")).alias("a"))
    pages = table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(link)), lambda x: x["a"]), "\n").alias("html"))
    return readers.keyed_links(pages, "html")
