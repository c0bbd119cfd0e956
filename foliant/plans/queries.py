"""Queries over the driver's tables, one or more for each operator family, each with DuckDB SQL beside it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as fn
from ..operators import aliases, audit, catalogue, hierarchy, joins, lifecycle, parsing, quality, repair, search
from ..session import shared_dir, table
from ..sources import readers
from ..streaming import state

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


FRAGMENT = "coalesce(len(list_filter(string_split_regex(trim(text, e' \\n\\t\\r'), '\\s+'), lambda t: regexp_full_match(t, '\\p{L}+') AND length(t) = 1))::DOUBLE / nullif(len(list_filter(string_split_regex(trim(text, e' \\n\\t\\r'), '\\s+'), lambda t: regexp_full_match(t, '\\p{L}+'))), 0), 0)::DOUBLE"


@query(f"SELECT doc_id, {FRAGMENT} AS frag FROM documents")
def qc_whitespace_frag(spark, d):
    return docs(spark, d).select("doc_id", quality.fragments(F.col("text")).alias("frag"))


@query(r"""SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]{2,}'))::BIGINT AS n_words,
len(regexp_extract_all(text, '[^\p{L}\p{N}_\s.,;:''"()\-/&]'))::DOUBLE / greatest(length(text), 1) AS symbol_share FROM documents""")
def qc_word_symbol_ratio(spark, d):
    t = F.col("text")
    return docs(spark, d).select("doc_id", quality.n_words(t).alias("n_words"), quality.symbol_share(t).alias("symbol_share"))


@query(r"""SELECT doc_id, len(list_filter(string_split_regex(text, '\s')[:-2], lambda t: regexp_full_match(t, '[B-HJ-Zb-hj-z]')))::BIGINT AS strays FROM documents""")
def qc_stray_letters(spark, d):
    return docs(spark, d).select("doc_id", quality.stray_letters(F.col("text")).alias("strays"))


@query(r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS t FROM documents), c AS (SELECT doc_id, t, count(*) AS n FROM t GROUP BY ALL),
s AS (SELECT doc_id, sum(n) AS n_alpha, sum(CASE WHEN regexp_matches(t, '[aeiou]') THEN n ELSE 0 END)::DOUBLE / sum(n) AS v, max(n)::DOUBLE / sum(n) AS m FROM c GROUP BY 1)
SELECT doc_id, coalesce(n_alpha, 0)::BIGINT AS n_alpha, coalesce(v, 0)::DOUBLE AS vowel_share, coalesce(m, 0)::DOUBLE AS top_share,
coalesce(n_alpha >= 20 AND v >= 0.55::DOUBLE AND m <= 0.15::DOUBLE, false) AS recoverable FROM documents LEFT JOIN s USING (doc_id)""")
def qc_top_token_share(spark, d):
    return quality.recoverable(docs(spark, d), "doc_id", "text")


LEXICON = r"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark"
SHORT = ", ".join(f"('{w}')" for w in quality.ABBREVIATIONS)
RATES = f"""lexicon AS ({LEXICON} UNION SELECT * FROM (VALUES {SHORT})), tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents),
rates AS (SELECT doc_id, count(*) AS n, count(lexicon.word)::DOUBLE / count(*) AS r FROM tok LEFT JOIN lexicon USING (word) GROUP BY 1),
hit AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_tokens, coalesce(r, 1.0)::DOUBLE AS hit_rate FROM documents LEFT JOIN rates USING (doc_id))"""


def lexicon(spark, d) -> DataFrame:
    return table(spark, d, "benchmark").select(F.explode(quality.word_tokens(F.col("text"))).alias("word")).distinct()


@query(f"WITH {RATES} SELECT * FROM hit")
def qc_dict_hitrate(spark, d):
    return quality.hit_rates(docs(spark, d), "doc_id", "text", lexicon(spark, d))


@query(r"""WITH c AS (SELECT doc_id, regexp_extract_all(text, '((?:19|20)\d{2}-\d{1,3})(?:\D|$)', 1) AS cases, regexp_extract_all(text, '(?i)\b(BCO\s*0*\d{1,3}(?:-\d{1,3})?)\b', 1) AS laws FROM documents)
SELECT doc_id, (len(cases) + len(laws))::BIGINT AS n_present, (len(list_filter(cases, lambda c: substr(c, 1, 4)::INT NOT BETWEEN 1973 AND 2026)) + len(list_filter(laws, lambda c: regexp_extract(c, '(\d+)', 1)::INT NOT BETWEEN 1 AND 63)))::BIGINT AS n_implausible,
len(cases) + len(laws) > 0 AS has_citation FROM c""")
def qc_digit_plausibility(spark, d):
    c = docs(spark, d).select("doc_id", quality.citations(F.col("text")).alias("c"))
    return c.select("doc_id", F.size("c.present").cast("long").alias("n_present"), F.size("c.implausible").cast("long").alias("n_implausible"), "c.has_citation")


LIMITS = quality.Limits(fragments=0.05, recovered=0.85, reread=0.50)


@query(f"""WITH {RATES}, v AS (SELECT source, CASE WHEN frag >= 0.05::DOUBLE AND hit_rate >= 0.85::DOUBLE THEN 'despace' WHEN hit_rate < 0.5::DOUBLE AND hit_rate < 0.85::DOUBLE THEN 'reocr' ELSE 'good' END AS verdict
FROM (SELECT doc_id, source, {FRAGMENT} AS frag FROM documents) JOIN hit USING (doc_id)) SELECT source, verdict, count(*) AS n FROM v GROUP BY ALL""")
def qc_verdict_by_source(spark, d):
    """The flagship: scan, scalar and token measures, verdict, counts. The despaced rate stands for the rate itself here (no vocabulary)."""
    frag = docs(spark, d).select("doc_id", "source", quality.fragments(F.col("text")).alias("frag"))
    met = frag.join(quality.hit_rates(docs(spark, d), "doc_id", "text", lexicon(spark, d)), "doc_id")
    return met.groupBy("source", quality.verdict(F.col("frag"), F.col("hit_rate"), F.col("hit_rate"), LIMITS).alias("verdict")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, n_chars >= 5 AND quality <= greatest(2.0::DOUBLE, n_chars * 0.5::DOUBLE) AND n_chars >= 0.85::DOUBLE * (n_chars + toxic * 1000) AS adopt FROM documents JOIN labels USING (doc_id)""")
def adopt_guard_pairs(spark, d):
    both = docs(spark, d).join(table(spark, d, "labels"), "doc_id")
    return both.select("doc_id", quality.adopt(F.col("n_chars"), F.col("quality"), F.col("n_chars") + F.col("toxic") * 1000, F.col("n_chars")).alias("adopt"))


@query(r"""WITH p AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents), f AS (SELECT doc_id, p, list_filter(range(1, len(p) + 1), lambda i: trim(p[i]) <> '') AS f FROM p),
e AS (SELECT doc_id, p, list_concat(f[1:1], f[-1:]) AS e FROM f), k AS (SELECT doc_id, p, list_filter(range(1, len(p) + 1), lambda i: NOT (list_contains(e, i) AND regexp_matches(p[i], '^[A-Z][a-z]+ [a-z]+ [a-z]+'))) AS k FROM e)
SELECT doc_id, (len(p) - len(k))::BIGINT AS dropped, CASE WHEN len(k) < len(p) THEN regexp_replace(regexp_replace(array_to_string(list_transform(k, lambda i: p[i]), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g') ELSE array_to_string(p, chr(10)) END AS text FROM k""")
def strip_edge_lines(spark, d):
    """REP-1 with the driver tables' own 'numbers': lines that begin with three words, dropped at the edges only."""
    new = repair.strip_headers(F.col("text"), headers="^(?!)", appendix="^(?!)", number="^[A-Z][a-z]+ [a-z]+ [a-z]+", edge=1)
    return docs(spark, d).select("doc_id", (F.size(F.split("text", "\n")) - F.size(F.split(new, "\n"))).cast("long").alias("_d"), new.alias("text"), F.col("text").alias("_t")).select("doc_id", "text", _dropped(F.col("_t")).alias("dropped"))


def _dropped(t):
    parts = F.split(t, "\n")
    full = F.filter(F.transform(parts, lambda x, i: F.when(F.trim(x) != "", i)), lambda i: i.isNotNull())
    edge = F.concat(F.slice(full, 1, 1), F.slice(F.reverse(full), 1, 1))
    return F.size(F.filter(parts, lambda x, i: F.array_contains(edge, i) & x.rlike("^[A-Z][a-z]+ [a-z]+ [a-z]+"))).cast("long")


def _entities(sql: str) -> str:
    for name, char in readers.ENTITIES.items():
        quoted = char.replace("'", "''")
        sql = f"replace({sql}, '{name}', '{quoted}')"
    return sql


VISIBLE = (
    "regexp_replace(regexp_replace(regexp_replace("
    + _entities(r"regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', '', 'g'), '(?i)</?(br|p|tr|li|h[0-9]|div|td)[^>]*>', chr(10), 'g'), '<[^>]+>', ' ', 'g')")
    + r", '[ \t\r]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '^ | $', '', 'g')"
)


@query(f"SELECT page_id, {VISIBLE} AS visible FROM pages")
def html_visible_text(spark, d):
    return table(spark, d, "pages").select("page_id", readers.visible_text(F.col("html")).alias("visible"))


@query("""SELECT page_id, k - 1 AS at, h[k] AS href FROM (SELECT page_id, h, unnest(range(1, len(h) + 1)) AS k FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS h FROM pages))""")
def html_links(spark, d):
    return readers.links(table(spark, d, "pages"), "page_id", "html").withColumn("at", F.col("at").cast("long"))


SEGMENT = r"regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1)"


@query(f"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="/([^"]*)"', 1)) AS path FROM pages)
SELECT page_id AS entity, 'broken_link' AS kind, path AS detail FROM l WHERE path NOT IN (SELECT {SEGMENT} FROM pages)""")
def broken_links(spark, d):
    pages = table(spark, d, "pages")
    text = F.array_join(F.transform(F.regexp_extract_all("html", F.lit('href="/([^"]*)"'), F.lit(1)), lambda h: F.concat(F.lit("]("), h, F.lit(")"))), " ")
    known = pages.select(F.regexp_extract("url", r"^https?://[^/]+/([^/?#]*)", 1).alias("path"))
    return audit.broken_links(pages.select(F.col("page_id").alias("entity"), text.alias("text")), known)


@query(r"""WITH f AS (SELECT doc_id, regexp_extract_all(text, '([A-Z][a-z]+ [a-z]{8,}[.,;]*)', 1) AS f FROM documents), g AS (SELECT doc_id, list_transform(f, lambda x: regexp_replace(x, '[.,;]+$', '')) AS g FROM f)
SELECT doc_id, array_to_string(list_filter(g, lambda x, i: list_position(g, x) = i), '|') AS found FROM g""")
def pattern_extract_distinct(spark, d):
    found = F.regexp_extract_all("text", F.lit("([A-Z][a-z]+ [a-z]{8,}[.,;]*)"), F.lit(1))
    return docs(spark, d).select("doc_id", F.array_join(F.array_distinct(F.transform(found, lambda x: F.regexp_replace(x, "[.,;]+$", ""))), "|").alias("found"))


@query("""WITH p AS (SELECT p_partkey, 1 + p_partkey % 30 AS a, 1 + p_size % 9 AS b, p_partkey % 4 AS n, p_partkey % 5 AS k FROM part)
SELECT p_partkey, array_to_string(CASE k WHEN 0 THEN list_transform(range(b, b + n + 1), lambda i: 'BCO ' || a || '-' || i) || ['RAO ' || a || '-' || b] WHEN 1 THEN ['RAO ' || a || '-' || b, 'RAO ' || (a + 1) || '-' || b]
WHEN 2 THEN ['BCO ' || a || '-' || b, 'BCO 7-2'] || list_transform(range(b, b + n + 1), lambda i: 'RAO 3-' || i) WHEN 3 THEN ['BCO ' || a || '-' || b] ELSE [] END, '|') AS sections FROM p""")
def range_expand(spark, d):
    """PAR-6: lists of targets from the keys and sizes of parts: ranges, kinds that carry over, letters, and prose."""
    a, b, n = ((c).cast("string") for c in (1 + F.col("p_partkey") % 30, 1 + F.col("p_size") % 9, F.col("p_partkey") % 4))
    up, next_ = (1 + F.col("p_size") % 9 + F.col("p_partkey") % 4).cast("string"), (2 + F.col("p_partkey") % 30).cast("string")
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    kinds = [text("BCO ", a, "-", b, "..", a, "-", up, ", RAO ", a, "-", b), text("RAO ", a, "-", b, ".e.5, ", next_, "-", b), text(a, "-", b, ", BCO 7-2a, RAO 3-", b, "..", up), text("(BCO ", a, "-", b, ")"), text("prose + ", n, " conforming")]
    rows = table(spark, d, "part").select("p_partkey", F.element_at(F.array(*kinds), (F.col("p_partkey") % 5 + 1).cast("int")).alias("targets"))
    return rows.select("p_partkey", F.array_join(parsing.target_sections(F.col("targets")), "|").alias("sections"))


@query(r"""SELECT c_custkey, array_to_string(list_filter(regexp_extract_all(lower(c_name || ' versus Session of ' || c_mktsegment), '[a-z][a-z''\-]{2,}'), lambda t: t NOT IN ('versus', 'session')), ' ') AS tokens FROM customer""")
def name_tokens(spark, d):
    name = F.concat("c_name", F.lit(" versus Session of "), "c_mktsegment")
    return table(spark, d, "customer").select("c_custkey", F.array_join(parsing.name_tokens(name), " ").alias("tokens"))


@query(r"""SELECT doc_id, CASE WHEN length(text) > 200 THEN regexp_replace(regexp_replace(substr(text, 1, 200), '(?s) [^ ]*$', ''), '[ ,;]+$', '') || ' …' ELSE text END AS head FROM documents""")
def truncate_word_boundary(spark, d):
    return docs(spark, d).select("doc_id", repair.truncate(F.col("text"), 200).alias("head"))


@query("SELECT doc_id, source, lang, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY source, lang ORDER BY n_chars DESC, doc_id) = 1")
def keep_best_per_group(spark, d):
    return joins.keep_best(docs(spark, d).select("doc_id", "source", "lang", "n_chars"), ["source", "lang"], [F.desc("n_chars"), F.asc("doc_id")])


@query("SELECT md5(text) AS text_md5, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def keep_first_dedup(spark, d):
    return joins.keep_first(docs(spark, d).select(F.md5("text").alias("text_md5"), "doc_id"), ["text_md5"], "doc_id")


@query("SELECT event_id, user_id, lead(event_id) OVER w AS next_event_id, lead(event_type) OVER w AS next_event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def next_in_partition(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return joins.next_in(e, ["user_id"], ["ts", "event_id"], ["event_id", "event_type"]).select("event_id", "user_id", "next_event_id", "next_event_type")


@query("SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_signup FROM events")
def forward_fill_context(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return joins.forward_fill(e, ["user_id"], ["ts", "event_id"], F.when(F.col("event_type") == "signup", F.col("event_id")), "last_signup").select("event_id", "last_signup")


@query("""WITH p AS (SELECT user_id, ts, max(event_id) AS purchase FROM events WHERE event_type = 'purchase' GROUP BY ALL), v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')
SELECT v.event_id, p.purchase FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.ts""")
def asof_event_state(spark, d):
    e = table(spark, d, "events")
    points = e.filter("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("at")).agg(F.max("event_id").alias("purchase"))
    return joins.asof(e.filter("event_type = 'view'").select("event_id", "user_id", "ts"), points, ["user_id"], "ts", "at", ["purchase"]).select("event_id", "purchase")


@query("""WITH l AS (SELECT doc_id, k AS line_no, p[k] AS line FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS k FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)))
SELECT doc_id, line_no, coalesce(last_value(CASE WHEN length(line) > 120 THEN line_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING), min(CASE WHEN length(line) > 120 THEN line_no END) OVER (PARTITION BY doc_id)) AS anchor FROM l""")
def asof_line_to_page(spark, d):
    """JN-10 with long lines as anchors; lines before the first take the first."""
    rows = readers.lines(docs(spark, d), "doc_id").withColumn("line_no", F.col("line_no").cast("long"))
    points = rows.filter(F.length("line") > 120).select("doc_id", F.col("line_no").alias("at"), F.col("line_no").alias("anchor"))
    return joins.asof(rows.select("doc_id", "line_no"), points, ["doc_id"], "line_no", "at", ["anchor"], clamp=True)


@query("""WITH o AS (SELECT c_nationkey AS n, min(c_custkey) AS c FROM customer GROUP BY 1) SELECT s_suppkey, arg_min(o.c, o.n) AS found FROM supplier LEFT JOIN o ON o.n BETWEEN s_nationkey + 1 AND s_nationkey + 3 GROUP BY 1""")
def first_match_window(spark, d):
    right = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("position")).agg(F.min("c_custkey").alias("c"))
    left = table(spark, d, "supplier").select("s_suppkey", (F.col("s_nationkey") + 1).alias("at"))
    return joins.first_in_following(left, right, "at", 2, [], "s_suppkey", "c", "found").select("s_suppkey", "found")


@query("SELECT event_id, count(CASE WHEN event_type = 'error' THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING) AS errors_ahead FROM events")
def bounded_lookahead_count(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts")
    return joins.look_ahead_count(e, ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 20, "errors_ahead").select("event_id", "errors_ahead")


@query("""SELECT user_id, string_agg(event_type, '>' ORDER BY ts, event_id) AS lifecycle, arg_max(event_type, (ts, event_id)) AS final, count(*) AS n FROM events GROUP BY 1""")
def lifecycle_thread(spark, d):
    t = lifecycle.threads(table(spark, d, "events"), ["user_id"], "ts", "event_id", "event_type", closed=("purchase",))
    return t.select("user_id", F.array_join(F.transform("lifecycle", lambda x: x["action"]), ">").alias("lifecycle"), "final", F.col("n").cast("long").alias("n"))


@query("SELECT final, count(*) AS n, count_if(k > 1) AS longer FROM (SELECT conv_id, arg_max(role, turn) AS final, count(*) AS k FROM conversations GROUP BY 1) GROUP BY 1")
def final_state_counts(spark, d):
    t = lifecycle.threads(table(spark, d, "conversations"), ["conv_id"], "turn", "text", "role")
    return t.groupBy("final").agg(F.count("*").alias("n"), F.count_if(F.col("n") > 1).alias("longer"))


@query(r"""WITH t AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(text, '[a-z]{10,}')) AS section FROM benchmark), c AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[a-z]{10,}')) AS section FROM documents)
SELECT doc_id AS case_id, string_agg(section, '|' ORDER BY section) AS matched FROM c WHERE section IN (SELECT section FROM t) GROUP BY 1""")
def array_overlap_join(spark, d):
    found = F.regexp_extract_all("text", F.lit("([a-z]{10,})"), F.lit(1))
    cases = docs(spark, d).select(F.col("doc_id").alias("case_id"), F.lit(0).alias("year"), found.alias("cited_as"), F.array().cast("array<string>").alias("cited_current"))
    targets = table(spark, d, "benchmark").select(F.explode(found).alias("section"))
    return joins.cases_citing(cases, targets).select("case_id", F.array_join("matched", "|").alias("matched"))


def passages(spark, d) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").alias("alias_id"), F.col("text").alias("alias"))


@query("SELECT item_id AS alias_id, doc_id FROM benchmark b JOIN documents d ON contains(lower(d.text), lower(b.text))")
def alias_contains_join(spark, d):
    return aliases.alias_matches(docs(spark, d), "doc_id", "text", passages(spark, d))


SHORT_ALIASES = r"SELECT item_id AS alias_id, regexp_extract(text, CASE item_id % 3 WHEN 0 THEN '^\S+' WHEN 1 THEN '^\S+ \S+' ELSE '^\S+ \S+ \S+' END) AS alias FROM benchmark"


@query(f"WITH a AS ({SHORT_ALIASES}) SELECT alias_id, doc_id FROM a JOIN documents d ON contains(lower(d.text), lower(a.alias))")
def alias_short_join(spark, d):
    """JN-20 with aliases of one to three words: how each passage begins."""
    b = table(spark, d, "benchmark")
    of = lambda n: F.regexp_extract("text", r"^\S+" + r" \S+" * (n - 1), 0)
    alias = F.when(F.col("item_id") % 3 == 0, of(1)).when(F.col("item_id") % 3 == 1, of(2)).otherwise(of(3))
    return aliases.alias_matches(docs(spark, d), "doc_id", "text", b.select(F.col("item_id").alias("alias_id"), alias.alias("alias")))


@query("SELECT item_id AS alias_id FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(lower(d.text), lower(b.text)))")
def roster_gaps(spark, d):
    gaps, _, _ = joins.reconcile(passages(spark, d), alias_contains_join(spark, d), docs(spark, d).select("doc_id"), "doc_id")
    return gaps.select("alias_id")


@query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE contains(lower(d.text), lower(b.text)))")
def roster_extra(spark, d):
    _, extra, _ = joins.reconcile(passages(spark, d), alias_contains_join(spark, d), docs(spark, d).select("doc_id"), "doc_id")
    return extra


@query("""SELECT s_suppkey AS key, min(c_custkey) AS relink FROM supplier JOIN customer ON s_nationkey = c_nationkey AND abs(CAST(s_acctbal AS INT) - CAST(c_acctbal AS INT)) <= 300 GROUP BY 1""")
def relink_within_range(spark, d):
    """JN-6 with nations as names and balances as years; halves go to the even number, as in its SQL."""
    tokens = lambda c: F.array(F.col(c).cast("string"))
    missing = table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), tokens("s_nationkey").alias("lead"), F.rint("s_acctbal").cast("int").alias("year"))
    cases = table(spark, d, "customer").select(F.col("c_custkey").alias("case_id"), F.col("c_custkey").alias("_seq"), tokens("c_nationkey").alias("lead"), F.rint("c_acctbal").cast("int").alias("year"))
    return joins.relink(missing, cases, 300)


@query("""WITH a AS (SELECT o_orderkey AS id, o_custkey AS section, year(o_orderdate) AS year FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT o_custkey AS section, year(o_orderdate) AS y, max(o_orderpriority) AS note FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL)
SELECT id, min(y) AS ratified_year, arg_min(note, y) AS ratification_note FROM a LEFT JOIN b ON a.section = b.section AND y BETWEEN year + 1 AND year + 2 GROUP BY 1""")
def ratification_window(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("section"), F.year("o_orderdate").alias("year"), "o_orderstatus", F.col("o_orderpriority").alias("note"))
    later = o.filter("o_orderstatus = 'O'").groupBy("section", "year").agg(F.max("note").alias("note"))
    out = joins.ratified(o.filter("o_orderstatus = 'F'").select("id", "section", "year"), later)
    return out.select("id", F.col("ratified_year").cast("long").alias("ratified_year"), "ratification_note")


@query("""WITH RECURSIVE e AS (SELECT row_number() OVER (ORDER BY adopted, f) AS k, * FROM (SELECT 1992 + n_nationkey % 7 AS adopted, '9-' || n_nationkey AS f, '9-' || ((n_nationkey * 3 + 1) % 25) AS t FROM nation)),
c AS (SELECT o_orderkey, '9-' || (o_custkey % 30) AS section, year(o_orderdate) - 2 AS y FROM orders),
r AS (SELECT o_orderkey, section, y, 0 AS k, section AS cur FROM c UNION ALL SELECT o_orderkey, section, y, r.k + 1, CASE WHEN e.adopted > y AND e.f = cur THEN e.t ELSE cur END FROM r JOIN e ON e.k = r.k + 1)
SELECT o_orderkey, section, CAST(y AS INTEGER) AS year, cur AS "current" FROM r WHERE k = 25""")
def concordance_resolve(spark, d):
    """JN-28, SRC-14: sections cited in orders' years, through the renumberings that the nations stand for, by their year."""
    mapping = F.array(F.struct(F.concat(F.lit("9-"), F.col("n_nationkey").cast("string")).alias("from"), F.concat(F.lit("9-"), ((F.col("n_nationkey") * 3 + 1) % 25).cast("string")).alias("to")))
    events = table(spark, d, "nation").select((1992 + F.col("n_nationkey") % 7).cast("int").alias("adopted_year"), F.lit("9").alias("chapter"), F.lpad(F.concat(F.lit("9-"), F.col("n_nationkey").cast("string")), 9, " ").alias("_by"), F.lit(0).alias("ga"), F.lit("renumbered").alias("kind"), F.lit("known").alias("status"), mapping.alias("mappings"))
    cites = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("9-"), (F.col("o_custkey") % 30).cast("string")).alias("section"), (F.year("o_orderdate") - 2).alias("year"))
    met = joins.resolve_sections(cites.select("section", "year").distinct(), readers.events_in_order(events))
    return cites.join(met, ["section", "year"]).select("o_orderkey", "section", "year", "current")


TERMS = r"WITH t AS (SELECT doc_id, i AS pos, w[i] AS term FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents)))"


def index(spark, d) -> DataFrame:
    return search.postings(docs(spark, d), "doc_id", "text")


STORED: dict[tuple[str, str], search.SearchIndex] = {}


def stored(spark, d) -> search.SearchIndex:
    """An index of the documents in the shared folder, built once for an application and a folder, then searched."""
    key = (spark.sparkContext.applicationId, d)
    if key not in STORED:
        STORED[key] = search.SearchIndex(spark, f"{shared_dir(spark)}/foliant/index-{uuid.uuid4().hex}").append(docs(spark, d), "doc_id", "text")
    return STORED[key]


SEARCHES = [
    "license OR inging", "the NOT und", "lic* AND (of OR der) NOT ing*", '"of the" NOT license OR schön', "with by + the", '"in th" * NOT (and OR was)', "the der OR NOTICE", '(license OR (sch* NOT ("und der" OR die))) AND e*',
    "AND the", "the NOT", "(the", '"open', "the OR OR der", "* NOT", "()", '"!?"', 'the NOT "!?"',
]  # of the last nine the last finds all with "the", the others nothing
HAS = r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents), d AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM w)"""
FOUND = [
    "h('license') OR h('inging')", "h('the') AND NOT h('und')", "p('lic') AND (h('of') OR h('der')) AND NOT p('ing')", "(h('of the') AND NOT h('license')) OR h('schön')", "h('with') AND h('by the')",
    "p('in th') AND NOT (h('and') OR h('was'))", "(h('the') AND h('der')) OR h('notice')", "(h('license') OR (p('sch') AND NOT (h('und der') OR h('die')))) AND p('e')", "h('the')",
]


@query(HAS + " ".join(["SELECT CAST(NULL AS INTEGER) AS query, CAST(NULL AS BIGINT) AS doc WHERE false"] + [
    f"UNION ALL SELECT {len(SEARCHES) - 1 if k == len(FOUND) - 1 else k}, doc_id FROM d WHERE " + re.sub(r"([hp])\('([^']*)'\)", lambda m: f"contains(s, ' {m[2]}{' ' if m[1] == 'h' else ''}')", sql) for k, sql in enumerate(FOUND)]))
def fts_or_not_prefix(spark, d):
    """FTS-2, FTS-6: operators by their precedence, nested, with phrases and prefixes, and queries that cannot be read."""
    found = [search.search(stored(spark, d), q).select(F.lit(k).alias("query"), "doc") for k, q in enumerate(SEARCHES)]
    return reduce(DataFrame.unionByName, found)


@query(TERMS + " SELECT doc_id AS doc FROM t WHERE term IN ('the', 'der') INTERSECT SELECT doc_id FROM t WHERE term IN ('schön', 'inging', 'license', 'www')")
def fts_match_and_or(spark, d):
    return search.search(stored(spark, d), "(the OR der) AND (schön OR inging OR license OR www)")


@query(TERMS + " SELECT DISTINCT a.doc_id AS doc FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1 WHERE a.term = 'of' AND b.term = 'the'")
def fts_phrase(spark, d):
    return search.search(stored(spark, d), '"of the"')


@query(r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents), h AS (SELECT doc_id, w, list_transform(w, lambda x: regexp_replace(lower(x), '[^\p{L}\p{N}]', '', 'g') = 'with') AS h FROM w),
s AS (SELECT doc_id, w, h, greatest(coalesce(nullif(list_position(h, true), 0), 1) - 1 - 5, 0) AS s FROM h)
SELECT doc_id, CASE WHEN s > 0 THEN '…' ELSE '' END || array_to_string(list_transform(range(s + 1, least(s + 10, len(w)) + 1), lambda i: CASE WHEN h[i] THEN '[' || w[i] || ']' ELSE w[i] END), ' ') || CASE WHEN s + 10 < len(w) THEN '…' ELSE '' END AS snippet FROM s""")
def fts_snippet(spark, d):
    return docs(spark, d).select("doc_id", search.snippet(F.col("text"), ["with"]).alias("snippet"))


@query("SELECT doc_id FROM documents WHERE text ILIKE '%license%' OR text ILIKE '%50\\%%' ESCAPE '\\'")
def fts_like(spark, d):
    return docs(spark, d).filter(search.like_any(F.col("text"), ["license", "50%"])).select("doc_id")


@query(r"""WITH q AS (SELECT item_id AS key, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]{9,}')) AS all_, regexp_extract_all(lower(text), '[\p{L}\p{N}]{9,}') AS o FROM benchmark),
l AS (SELECT DISTINCT key, unnest(o) AS term FROM q), """ + TERMS.removeprefix("WITH ") + r""", d AS (SELECT DISTINCT doc_id, term FROM t),
h AS (SELECT l.key, d.doc_id AS doc, count(*) AS lead_hits FROM l JOIN d USING (term) GROUP BY ALL),
f AS (SELECT DISTINCT key, doc_id AS doc FROM (SELECT key, unnest(o[1:4]) AS term FROM q) JOIN d USING (term)),
s AS (SELECT h.*, round(lead_hits * 3.0::DOUBLE, 1) AS score FROM h SEMI JOIN f USING (key, doc))
SELECT key, doc, score, lead_hits, rank FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, doc) AS rank FROM s) WHERE rank <= 4""")
def scored_locate_topk(spark, d):
    lead = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]{9,})"), F.lit(1))
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("key"), lead.alias("lead"), F.array().cast("array<string>").alias("court"), F.lit(0).alias("year"), F.lit(None).cast("int").alias("ga"))
    known = docs(spark, d).select(F.col("doc_id").alias("doc"), F.lit(0).alias("year"), F.lit(None).cast("int").alias("ga"))
    return search.locate(index(spark, d), asked, known).select("key", "doc", "score", "lead_hits", F.col("rank").cast("long").alias("rank"))


@query(r"""WITH q AS (SELECT item_id AS key, regexp_extract_all(lower(text), '[\p{L}\p{N}]{9,}') AS o FROM benchmark), l AS (SELECT DISTINCT key, unnest(o) AS term FROM q), """ + TERMS.removeprefix("WITH ") + r""",
f AS (SELECT DISTINCT key, doc_id AS doc FROM (SELECT key, unnest(o[1:4]) AS term FROM q) JOIN t USING (term)),
h AS (SELECT f.key, f.doc, count(*) AS lead_hits FROM f JOIN l ON l.key = f.key JOIN documents d ON d.doc_id = f.doc AND contains(lower(d.text), l.term) GROUP BY ALL),
s AS (SELECT *, round(lead_hits * 3.0::DOUBLE, 1) AS score FROM h)
SELECT key, doc, score, lead_hits, rank FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY score DESC, doc) AS rank FROM s) WHERE rank <= 4""")
def located_by_substring(spark, d):
    """AGG-11, JN-5: hits counted anywhere in the texts of the candidates."""
    lead = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]{9,})"), F.lit(1))
    asked = table(spark, d, "benchmark").select(F.col("item_id").alias("key"), lead.alias("lead"), F.array().cast("array<string>").alias("court"), F.lit(0).alias("year"), F.lit(None).cast("int").alias("ga"))
    known = docs(spark, d).select(F.col("doc_id").alias("doc"), "text", F.lit(0).alias("year"), F.lit(None).cast("int").alias("ga"))
    return search.locate(index(spark, d), asked, known).select("key", "doc", "score", "lead_hits", F.col("rank").cast("long").alias("rank"))


def world(spark, d) -> DataFrame:
    """Regions, nations and suppliers as nested children."""
    s = table(spark, d, "supplier").select("s_nationkey", F.struct(F.lit("supplier").alias("type"), F.col("s_name").alias("label"), F.lit("").alias("title")).alias("n"))
    n = table(spark, d, "nation").join(s.groupBy("s_nationkey").agg(F.sort_array(F.collect_list("n")).alias("children")), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    none = F.array().cast("array<struct<type:string,label:string,title:string>>")
    n = n.select("n_regionkey", F.struct(F.lit("nation").alias("type"), F.col("n_name").alias("label"), F.lit("").alias("title"), F.coalesce("children", none).alias("children")).alias("n"))
    r = table(spark, d, "region").join(n.groupBy("n_regionkey").agg(F.sort_array(F.collect_list("n")).alias("children")), F.col("r_regionkey") == F.col("n_regionkey"))
    return r.select(F.col("r_name").alias("vol"), F.array(F.struct(F.lit("region").alias("type"), F.col("r_name").alias("label"), F.lit("").alias("title"), "children")).alias("parts"))


WORLD = """WITH n AS (SELECT r_name AS vol, n_name, n_nationkey FROM region JOIN nation ON r_regionkey = n_regionkey), a AS (SELECT r_name AS vol, 'region' AS type, r_name AS label, 0 AS level, '' AS k1, '' AS k2 FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation)
UNION ALL SELECT vol, 'nation', n_name, 1, n_name, '' FROM n UNION ALL SELECT vol, 'supplier', s_name, 2, n_name, s_name FROM n JOIN supplier ON n_nationkey = s_nationkey),
f AS (SELECT vol, type, label, level, row_number() OVER (PARTITION BY vol ORDER BY k1, k2) - 1 AS seq FROM a)"""


@query("""WITH RECURSIVE c AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 70 > 0 AND c_custkey > 1 THEN c_custkey - 1 END AS up, c_nationkey::VARCHAR AS label FROM customer),
r AS (SELECT id, 0 AS level, label AS path FROM c WHERE up IS NULL UNION ALL SELECT c.id, level + 1, path || '/' || label FROM c JOIN r ON c.up = r.id) SELECT id AS node_id, level::INT AS level, path FROM r""")
def tree_path_any_depth(spark, d):
    """TRE-3: customers in chains of 70."""
    k = F.col("c_custkey")
    nodes = table(spark, d, "customer").select(k.alias("node_id"), F.when((k % 70 > 0) & (k > 1), k - 1).alias("parent_id"), F.col("c_nationkey").cast("string").alias("label"))
    return hierarchy.paths(nodes, separator="/")


@query(WORLD + " SELECT vol, type, label, level::BIGINT AS level, seq FROM f")
def tree_flatten(spark, d):
    return hierarchy.flatten(world(spark, d), "parts").select("vol", "type", "label", F.col("level").cast("long").alias("level"), F.col("seq").cast("long").alias("seq"))


@query("SELECT s_suppkey::BIGINT AS supplier, r_name || ' > ' || n_name || ' > ' || s_name AS path FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def tree_path(spark, d):
    r = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node_id"), F.lit(None).cast("string").alias("parent_id"), F.col("r_name").alias("label"))
    n = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node_id"), F.concat(F.lit("r"), "n_regionkey").alias("parent_id"), F.col("n_name").alias("label"))
    s = table(spark, d, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("node_id"), F.concat(F.lit("n"), "s_nationkey").alias("parent_id"), F.col("s_name").alias("label"))
    return hierarchy.paths(r.unionByName(n).unionByName(s)).filter("level = 2").select(F.substring("node_id", 2, 20).cast("long").alias("supplier"), "path")


@query("""WITH s AS (SELECT o_custkey AS key, o_orderdate AS at, max(o_orderkey) AS section FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY ALL)
SELECT o.o_orderkey, s.section FROM orders o ASOF LEFT JOIN s ON o.o_custkey = s.key AND o.o_orderdate >= s.at""")
def enclosing_section(spark, d):
    """JN-11: the customer's latest urgent order at or before each order."""
    o = table(spark, d, "orders")
    points = o.filter("o_orderpriority LIKE '1%'").groupBy("o_custkey", F.col("o_orderdate").alias("at")).agg(F.max("o_orderkey").alias("section"))
    return joins.asof(o.select("o_orderkey", "o_custkey", "o_orderdate"), points, ["o_custkey"], "o_orderdate", "at", ["section"]).select("o_orderkey", "section")


@query(WORLD + " SELECT vol, string_agg(repeat('  ', level) || '- ' || label, chr(10) ORDER BY seq) AS outline FROM f GROUP BY 1")
def outline_render(spark, d):
    return hierarchy.outline(hierarchy.flatten(world(spark, d), "parts"), "vol")


@query("""SELECT type, count(*) AS n, count(DISTINCT title) AS titles, sum(length(url))::BIGINT AS url_chars FROM (SELECT 'document' AS type, source AS title, 'd/' || doc_id AS url FROM documents UNION ALL SELECT 'page', url, url FROM pages WHERE url NOT LIKE 'http://%'
UNION ALL SELECT 'conversation', role, 'c/' || conv_id FROM conversations UNION ALL SELECT 'benchmark', 'item ' || item_id, 'b/' || item_id FROM benchmark) GROUP BY 1""")
def search_index_union(spark, d):
    one = lambda t, kind, title, url: catalogue.record(t, kind, title, url)
    out = catalogue.union_index(
        one(docs(spark, d), "document", F.col("source"), F.concat(F.lit("d/"), "doc_id")), one(table(spark, d, "pages"), "page", F.col("url"), F.col("url")),
        one(table(spark, d, "conversations"), "conversation", F.col("role"), F.concat(F.lit("c/"), "conv_id")), one(table(spark, d, "benchmark"), "benchmark", F.concat(F.lit("item "), "item_id"), F.concat(F.lit("b/"), "item_id")),
        without=("http://",))
    return out.groupBy("type").agg(F.count("*").alias("n"), F.count_distinct("title").alias("titles"), F.sum(F.length("url")).alias("url_chars"))


@query("""WITH o AS (SELECT o_orderkey, 1970 + o_orderkey % 55 AS y, 1 + o_custkey % 150 AS n, o_orderkey % 6 AS k FROM orders)
SELECT o_orderkey, CASE WHEN k < 5 THEN y || '-' || n || CASE WHEN k = 2 THEN 'b' ELSE '' END END AS roster, CASE WHEN k < 5 THEN y || '-' || n END AS audit,
CASE WHEN k < 5 THEN y || '-' || CASE WHEN n < 10 THEN '0' ELSE '' END || n || CASE WHEN k = 2 THEN 'b' ELSE '' END END AS stub FROM o""")
def case_key_normalise(spark, d):
    """Numbers as rosters write them: padded, with a short year, with a letter, for two cases, after words, and unknown."""
    y, n = 1970 + F.col("o_orderkey") % 55, (1 + F.col("o_custkey") % 150).cast("string")
    short, pad = F.lpad((y % 100).cast("string"), 2, "0"), F.when(F.length(n) < 2, F.lpad(n, 2, "0")).otherwise(n)
    text = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts])
    kinds = [text(y, "-", pad), text(short, "-", n), text(y, "-", pad, "B"), text(y, "-", pad, "&-07"), text("Case ", short, "-", n), text(y, "-__")]
    raw = F.element_at(F.array(*kinds), (F.col("o_orderkey") % 6 + 1).cast("int"))
    return table(spark, d, "orders").select("o_orderkey", fn.case_key(raw).alias("roster"), fn.case_key(raw, suffix=False).alias("audit"), fn.case_key(raw, pad=2).alias("stub"))


@query("""SELECT o_orderkey, o_orderkey || CASE WHEN o_orderkey % 100 BETWEEN 10 AND 20 THEN 'th' WHEN o_orderkey % 10 = 1 THEN 'st' WHEN o_orderkey % 10 = 2 THEN 'nd' WHEN o_orderkey % 10 = 3 THEN 'rd' ELSE 'th' END AS nth FROM orders""")
def ordinal_format(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fn.ordinal(F.col("o_orderkey")).alias("nth"))


@query("SELECT p_partkey, coalesce(nullif(substr(regexp_replace(regexp_replace(lower(p_name || ' / ' || p_type), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 60), ''), 'report') AS slug FROM part")
def slugify(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.slugify(F.concat("p_name", F.lit(" / "), "p_type")).alias("slug"))


@query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace('THE ' || upper(p_name) || ' MINORITY REPORT PART II', '^(THE|A|AN)\s+', ''), '\b(MAJORITY|MINORITY|INITIAL|FINAL|PRELIMINARY)\s+REPORT\b', '', 'g'), '\bPARTS?\s+[IVX]+(\s*[-–]\s*[IVX]+)?\b', '', 'g'), '[^A-Z0-9 ]|\s+', ' ', 'g')) AS key FROM part""")
def topic_key(spark, d):
    return table(spark, d, "part").select("p_partkey", fn.topic_key(F.concat(F.lit("The "), "p_name", F.lit(" Minority Report Part II"))).alias("key"))


@query("""SELECT doc_id AS entity, 'unlabelled' AS kind, source AS detail FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT doc_id, 'missing_section', 'the' FROM documents WHERE NOT contains(text, 'the')""")
def audit_issues(spark, d):
    entities = docs(spark, d).select(F.col("doc_id").alias("entity"), "text", "source")
    bare = entities.join(table(spark, d, "labels").select(F.col("doc_id").alias("entity")), "entity", "left_anti")
    return audit.all_issues(audit.issues(bare, "unlabelled", F.col("source")), audit.missing_sections(entities, ["the"]))


@query("""WITH e AS (SELECT doc_id AS file, md5(text) AS number, doc_id % 40 + 1980 AS year, octet_length(encode(text)) AS size, 1995 AS docket FROM documents)
SELECT number, file, CASE WHEN year >= docket THEN year - docket ELSE docket - year + 50 END AS distance FROM e QUALIFY row_number() OVER (PARTITION BY number ORDER BY distance, size DESC, file) = 1""")
def cross_volume_dedup(spark, d):
    pages = docs(spark, d).select(F.col("doc_id").alias("file"), F.array(F.concat(F.lit("1995-"), F.md5("text"))).alias("numbers"), (F.col("doc_id") % 40 + 1980).alias("year"), "text")
    best, _ = joins.one_page_each(pages)
    return best.select(F.substring("number", 6, 40).alias("number"), "file", "distance")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def resumable_todo(spark, d):
    return state.todo(docs(spark, d).select("doc_id"), table(spark, d, "labels"), ["doc_id"])


@query("""WITH n AS (SELECT user_id AS key, arg_max(CASE WHEN event_type = 'error' THEN '' ELSE event_type END, (ts, event_id)) AS text, max(ts) AS ts FROM events GROUP BY 1) SELECT key, text FROM n WHERE text <> ''""")
def notes_lww_state(spark, d):
    """STR-2: users' last events as notes, an error as an empty note, which deletes."""
    log = table(spark, d, "events").select(
        F.col("user_id").alias("key"), F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("text"), F.lit(False).alias("star"),
        F.lit(None).cast("string").alias("lean"), F.lit(None).cast("string").alias("seen"), F.struct("ts", "event_id").alias("ts"))
    return state.latest_notes(log).select("key", "text")


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, d):
    """STR-8, an extra."""
    return state.counts_by_window(table(spark, d, "events"))


@query("""WITH r AS (SELECT region.r_name AS section, k, '| ' || n_nationkey || ' | ' || n_name || ' |' AS line FROM region JOIN (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation) ON r_regionkey = n_regionkey)
SELECT section, (k + 3)::BIGINT AS line_no, split_part(line, ' | ', 1)[3:] AS key, replace(split_part(line, ' | ', 2), ' |', '') AS name FROM r""")
def markdown_table_scan(spark, d):
    """SRC-7: nations rendered as one Markdown table a region, read back."""
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    body = n.select("r_name", "n_nationkey", F.concat(F.lit("| "), "n_nationkey", F.lit(" | "), "n_name", F.lit(" |")).alias("l"))
    text = body.groupBy("r_name").agg(F.concat(F.lit("## "), F.first("r_name"), F.lit("\n| key | name |\n|---|---|\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "l"))), lambda x: x["l"]), "\n")).alias("text"))
    rows = readers.pipe_tables(readers.lines(text, "r_name"), "r_name")
    return rows.select("section", F.col("line_no").cast("long").alias("line_no"), F.get("cells", F.lit(0)).alias("key"), F.get("cells", F.lit(1)).alias("name"))


TERMS_OF = {"phrase": ["church in America"], "common": ["church", "presbytery"], "name": ["roberts"], "shifted": ["church in"]}


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'the church in America, ' || p_name WHEN 1 THEN 'Robert S. went, ' || p_name WHEN 2 THEN p_name || ' J U N E 3' ELSE p_name || ', Presbytery of the church in' END AS fixed FROM part""")
def tree_trie_despace(spark, d):
    """REP-2, REP-3: names of parts beside broken phrases, and what only looks broken."""
    whole = F.array(F.concat(F.lit("the ch urch in amer ica, "), "p_name"), F.concat(F.lit("Robert S. went, "), "p_name"), F.concat("p_name", F.lit(" J U N E 3")), F.concat("p_name", F.lit(", Pres bytery of the ch urchin")))
    return repair.despace(table(spark, d, "part").select("p_partkey", F.element_at(whole, (F.col("p_partkey") % 4 + 1).cast("int")).alias("fixed")), "fixed", TERMS_OF)


# What stands before a document's text, by its number, so that the documents of a language read like a volume of minutes with reviews.
SHAPES = [
    "'1. That the Minutes of ' || source || ' Presbytery'", "'c. exceptions of substance:'", "'Exception: March 7, 1998: BCO ' || doc_id || '-3 was not recorded'", "'General: RAO 16-3 no record of meeting ' || doc_id", "'Response: the clerk agrees, ' || doc_id",
    "'2) Minutes were not signed by the clerk of ' || doc_id", "'d. Responses found satisfactory:'", "'Exception: no quorum at meeting ' || doc_id", "'That no response to the 25th General Assembly was submitted'", "'a. Be approved without exception: ' || doc_id",
    "'Rationale: see ' || doc_id", "'<a id=\"ga25-p' || doc_id || '\"></a>'",
]
SHAPE = "CASE WHEN doc_id % 100 = 0 THEN 'II. Report concerning the Minutes of presbyteries' WHEN doc_id % 331 = 330 THEN 'IX. Other business' " + " ".join(f"WHEN doc_id % 12 = {k} THEN {x}" for k, x in enumerate(SHAPES)) + " END"
LIKE = {k: f"regexp_matches(line, '{v}')" for k, v in parsing.REVIEW.items()}


@query(rf"""WITH raw AS (SELECT lang AS vol, doc_id * 1000 AS line_no, {SHAPE} AS line FROM documents
  UNION ALL SELECT lang, doc_id * 1000 + i, l[i] FROM (SELECT lang, doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT lang, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
b AS (SELECT *, row_number() OVER (PARTITION BY vol ORDER BY line_no) AS r, CASE WHEN {LIKE["body"]} THEN 1 ELSE 0 END AS is_body FROM raw),
look AS (SELECT *, coalesce(sum(is_body) OVER (PARTITION BY vol ORDER BY r ROWS BETWEEN 1 FOLLOWING AND 899 FOLLOWING), 0) AS n FROM b),
head AS (SELECT vol, r AS r0 FROM look WHERE {LIKE["region"]} AND NOT {LIKE["index"]} AND n > 0 QUALIFY row_number() OVER (PARTITION BY vol ORDER BY n DESC, r) = 1),
stop AS (SELECT vol, min(r) AS r1 FROM b JOIN head USING (vol) WHERE r > r0 AND {LIKE["top"]} AND NOT regexp_matches(line, 'Presbytery|Minutes') GROUP BY vol),
region AS (SELECT b.* FROM b JOIN head USING (vol) LEFT JOIN stop USING (vol) WHERE r >= r0 AND (r1 IS NULL OR r < r1)),
said AS (SELECT *, lower(line) AS low FROM region),
m AS (SELECT *, CASE WHEN {LIKE["forwarded"]} AND NOT {LIKE["response"]} THEN 'unsatisfactory' WHEN contains(low, 'unsatisfactory') THEN 'unsatisfactory' WHEN contains(low, 'satisfactory') THEN 'satisfactory' WHEN contains(low, 'without exception') THEN 'skip'
  WHEN contains(low, 'exception of substance') OR contains(low, 'exceptions of substance') THEN 'raised' WHEN contains(low, 'exception of form') OR contains(low, 'exceptions of form') THEN 'skip' END AS mode FROM said),
k AS (SELECT *, CASE WHEN {LIKE["body"]} THEN 'body' WHEN mode IS NOT NULL THEN 'mode' WHEN {LIKE["exception"]} THEN 'exception' WHEN length(regexp_extract(line, '{parsing.REVIEW["numbered"]}', 1)) > 12 THEN 'numbered' WHEN {LIKE["dated"]} THEN 'dated'
  WHEN {LIKE["response"]} THEN 'response' ELSE 'text' END AS kind FROM m),
c AS (SELECT *, last_value(CASE WHEN kind = 'body' THEN regexp_extract(line, '{parsing.REVIEW["body"]}', 1) END IGNORE NULLS) OVER w AS body, last_value(CASE WHEN kind = 'body' THEN 'none' WHEN kind = 'mode' THEN mode END IGNORE NULLS) OVER w AS finding,
  last_value(nullif(regexp_extract(line, '{parsing.REVIEW["anchor"]}', 1), '') IGNORE NULLS) OVER w AS page_anchor FROM k WINDOW w AS (PARTITION BY vol ORDER BY r ROWS UNBOUNDED PRECEDING)),
f AS (SELECT * FROM c WHERE finding IN ('raised', 'satisfactory', 'unsatisfactory') OR kind IN ('body', 'mode')),
o AS (SELECT *, sum(CASE WHEN kind IN ('exception', 'numbered', 'dated') THEN 1 ELSE 0 END) OVER w AS item, last_value(CASE WHEN kind IN ('body', 'mode') THEN 0 WHEN kind IN ('exception', 'numbered', 'dated') THEN 1 END IGNORE NULLS) OVER w AS open
  FROM f WINDOW w AS (PARTITION BY vol ORDER BY r ROWS UNBOUNDED PRECEDING))
SELECT vol, CAST(item AS BIGINT) AS item, any_value(body) AS body, any_value(finding) AS finding, min(line_no) AS first_line, max(line_no) AS last_line, count(*) AS n_lines, count(*) FILTER (WHERE kind = 'response') AS n_replies, first(page_anchor ORDER BY line_no) AS page_anchor,
  max(CASE WHEN kind = 'dated' THEN regexp_extract(line, '{parsing.REVIEW["dated"]}', 1) WHEN kind = 'exception' AND contains(line, '1998: ') THEN 'March 7, 1998' ELSE '' END) AS dates FROM o WHERE open = 1 GROUP BY vol, item""")
def review_state_machine(spark, d):
    """PAR-3, PAR-4, WIN-9, WIN-11: all lines of all documents of a language as one volume: its review region, and in it body, mode and open exception carried down."""
    own = docs(spark, d).select("lang", "doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    shape = own.select(F.col("lang").alias("vol"), (F.col("doc_id") * 1000).alias("line_no"), F.expr(SHAPE).alias("line"))
    text = own.select(F.col("lang").alias("vol"), "doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line")).select("vol", (F.col("doc_id") * 1000 + F.col("at") + 1).alias("line_no"), "line")
    events = parsing.review_events(shape.unionByName(text), parity=True)
    return events.groupBy("vol", "item").agg(
        F.first("body").alias("body"), F.first("finding").alias("finding"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count("*").alias("n_lines"),
        F.count_if(F.col("kind") == "response").alias("n_replies"), F.min_by("page_anchor", "line_no").alias("page_anchor"), F.max("dates").alias("dates"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
