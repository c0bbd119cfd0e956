"""Queries that write the driver's tables in the reference's formats and read them back, streams among them, and repair in Python workers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import quality, repair, search
from ..session import shared_dir, table
from ..sources import readers, sinks
from ..streaming import state
from . import builds
from .queries import FRAGMENT, LEXICON, SHORT, docs, query

lit, col = F.lit, F.col


def folder(spark, name):
    return f"{shared_dir(spark)}/foliant/{name}-{uuid.uuid4().hex}"


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS segment FROM customer")
def json_lines_round_trip(spark, d):
    """SNK-4, SRC-1, FN-16: nulls stay."""
    path = folder(spark, "lines")
    sinks.write_json_lines(table(spark, d, "customer").select("c_custkey", "c_name", F.when(col("c_custkey") % 2 == 0, col("c_mktsegment")).alias("segment")), path)
    return readers.json_lines(spark, path, "c_custkey long, c_name string, segment string")


@query("SELECT c_custkey, c_name FROM customer")
def json_lines_missing(spark, d):
    """SRC-1: of two paths, one is not there and adds no rows."""
    path, schema = folder(spark, "lines"), "c_custkey long, c_name string"
    sinks.write_json_lines(table(spark, d, "customer").select("c_custkey", "c_name"), path)
    return readers.json_lines(spark, path, schema).unionByName(readers.json_lines(spark, folder(spark, "none"), schema))


@query("SELECT n_nationkey, n_name FROM nation")
def json_document_round_trip(spark, d):
    """SNK-7, SRC-3: one array, a row for each element."""
    path = folder(spark, "document")
    sinks.json_array(table(spark, d, "nation").select("n_nationkey", "n_name"), ["n_nationkey"]).write.text(path)
    return readers.json_document(spark, path, "n_nationkey int, n_name string")


@query("SELECT n_name AS key, n_regionkey AS value FROM nation")
def json_map_round_trip(spark, d):
    """SRC-3: one object, a row for each key."""
    path = folder(spark, "map")
    whole = F.map_from_entries(F.collect_list(F.struct("n_name", "n_regionkey")))
    table(spark, d, "nation").agg(F.to_json(whole).alias("value")).write.text(path)
    return readers.json_map(spark, path, "int")


@query("SELECT row_number() OVER (ORDER BY n_nationkey) AS line_no, n_name AS line FROM nation")
def text_lines_round_trip(spark, d):
    """SRC-4: numbered lines of a text file."""
    path = folder(spark, "text")
    table(spark, d, "nation").select("n_name", "n_nationkey").orderBy("n_nationkey").coalesce(1).select(col("n_name").alias("value")).write.text(path)
    return readers.text_lines(spark, path).filter("line <> ''").select(col("line_no").cast("long").alias("line_no"), "line")


@query("""SELECT n_nationkey::VARCHAR AS c0, n_name AS c1, 'says "' || n_regionkey AS c2 FROM nation WHERE n_nationkey = 7""")
def tsv_lookup(spark, d):
    """SRC-5: the rows of a key; quotes are plain characters."""
    path = folder(spark, "tsv")
    cells = F.concat_ws("\t", col("n_nationkey").cast("string"), "n_name", F.concat(lit('says "'), col("n_regionkey").cast("string")))
    table(spark, d, "nation").select(cells.alias("value")).write.text(path)
    return readers.tsv_row(spark, path, "7", 3)


@query("SELECT 'r' || n_regionkey AS slug, string_agg('# ' || n_name, chr(10) || chr(10) ORDER BY n_name) AS page FROM nation WHERE n_nationkey < 15 GROUP BY 1")
def page_folders(spark, d):
    """SNK-5, SNK-6: a file for each slug; pages of an earlier run are gone."""
    path, n = folder(spark, "pages"), table(spark, d, "nation")
    page = lambda df, slug: df.select(F.concat(lit(slug), col("n_regionkey").cast("string")).alias("slug"), F.concat(lit("# "), "n_name").alias("page"))
    sinks.write_pages(page(n, "old"), path)
    sinks.write_pages(page(n.filter("n_nationkey < 15"), "r"), path)
    return spark.read.text(f"{path}/*.md", wholetext=True).select(F.regexp_extract("_metadata.file_name", "^(.*)[.]md$", 1).alias("slug"), col("value").alias("page"))


@query("SELECT r_regionkey, r_name FROM region")
def backup_kept_once(spark, d):
    """SNK-10: the second backup leaves the first as it is."""
    path, r = folder(spark, "backup"), table(spark, d, "region")
    sinks.backup_once(r, path)
    sinks.backup_once(r.filter("r_regionkey > 2"), path)
    return spark.read.schema(r.schema).parquet(path)


@query(r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents) SELECT doc_id AS doc FROM w WHERE list_contains(w, 'license') OR list_contains(w, 'und')""")
def stored_index_search(spark, d):
    """FTS-2, SNK-2: an index that grows by three segments, then merged to one, searched without the texts."""
    own = search.SearchIndex(spark, folder(spark, "segments"))
    for k in range(3):
        own.append(table(spark, d, "documents").filter(F.pmod("doc_id", lit(3)) == k), "doc_id", "text")
    return search.search(own.merge().sweep(), "(license OR und)")


@query("""SELECT n_regionkey::VARCHAR AS vol, n_nationkey AS pdf_page, CASE WHEN n_nationkey % 5 = 3 THEN 'error: unreadable' ELSE 'ok' END AS status, CASE WHEN n_nationkey % 5 <> 3 THEN 'v' || n_regionkey || 'p' || n_nationkey END AS new_text FROM nation""")
def pages_recognised(spark, d):
    """SRC-12: a reader's errors become rows."""

    def reader(vol: str, page: int) -> str:
        if page % 5 == 3:
            raise ValueError("unreadable")
        return f"v{vol}p{page}"

    return readers.recognise(table(spark, d, "nation").select(col("n_regionkey").cast("string").alias("vol"), col("n_nationkey").alias("pdf_page")), reader)


@query("""WITH e AS (SELECT user_id AS key, arg_max({'t': CASE WHEN event_id % 5 = 0 THEN '' ELSE 'note ' || event_id END, 'ts': event_id}, event_id) AS n FROM events GROUP BY 1) SELECT key, n.t AS text, n.ts AS ts FROM e WHERE n.t <> ''""")
def streamed_notes(spark, d):
    """STR-2, STR-3 on a stream: the newest note of each key, empty ones gone."""
    path, schema = folder(spark, "notes"), table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    notes = stream.select(col("user_id").alias("key"), F.when(col("event_id") % 5 == 0, "").otherwise(F.concat(lit("note "), col("event_id").cast("string"))).alias("text"),
                          lit(False).alias("star"), lit(None).cast("string").alias("lean"), lit("").alias("seen"), col("event_id").alias("ts"))
    state.keep_notes(notes, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return state.latest_notes(state.read_notes(spark, f"{path}/out")).select("key", "text", "ts")


@query("""WITH e AS (SELECT user_id AS key, arg_max({'t': CASE WHEN event_id % 5 = 0 THEN '' ELSE 'note ' || event_id END, 'ts': event_id}, event_id) AS n FROM events GROUP BY 1) SELECT key, n.t AS text, n.ts AS ts FROM e WHERE n.t <> ''""")
def compacted_notes(spark, d):
    """STR-2, STR-3: a stream in four batches, stopped and taken up again, its changes made a snapshot in between."""
    path, e = folder(spark, "notes"), table(spark, d, "events")
    for half in (0, 1):
        e.filter(col("event_id") % 2 == half).repartition(2, "event_id").write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        notes = stream.select(col("user_id").alias("key"), F.when(col("event_id") % 5 == 0, "").otherwise(F.concat(lit("note "), col("event_id").cast("string"))).alias("text"),
                              lit(False).alias("star"), lit(None).cast("string").alias("lean"), lit("").alias("seen"), col("event_id").alias("ts"))
        state.keep_notes(notes, f"{path}/out", f"{path}/checkpoint").awaitTermination()
        state.compact_notes(spark, f"{path}/out")
    return state.latest_notes(state.read_notes(spark, f"{path}/out")).select("key", "text", "ts")


@query("SELECT event_id, event_type FROM events")
def streamed_log(spark, d):
    """STR-1 on a stream: each row once, and none again when the log is resumed."""
    path, schema = folder(spark, "log"), table(spark, d, "events").schema
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
        state.log_results(stream.select("event_id", "event_type"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, d):
    """STR-8, an extra."""
    return state.sessions(table(spark, d, "events"))


TERMS = {"phrase": ["church in America"], "common": ["presbytery"], "name": ["smith"]}


@query("""SELECT c_custkey, 1990 + c_custkey % 20 AS year, CASE WHEN c_custkey % 20 <= 12 THEN 'the presbytery of the church in America, Smith said: the ' ELSE 'teh pres bytery of the ch urch in amer ica, Smi th said: teh ' END || c_name AS text FROM customer""")
def despaced_by_era(spark, d):
    """REP-2 to REP-5: texts up to 2002 are corrected and despaced, later ones left alone."""
    c = table(spark, d, "customer").select("c_custkey", (lit(1990) + col("c_custkey") % 20).alias("year"), F.concat(lit("teh pres bytery of the ch urch in amer ica, Smi th said: teh "), "c_name").alias("text"))
    return repair.despace(c, "text", TERMS, {"teh": "the"}, "year")


REPAIR = quality.Limits(fragments=0.25, recovered=0.5, reread=0.4)
BROKEN = "(6 + length(text) // 24)::INT"  # how many broken words go before a text
PUT = f"CASE doc_id % 3 WHEN 0 THEN repeat('p r e s b y t e r y of ', {BROKEN}) WHEN 1 THEN repeat('zz q qq v ', {BROKEN}) ELSE '' END"


@query(rf"""WITH d AS (SELECT doc_id, {PUT} || text AS text, CASE WHEN doc_id % 3 = 0 THEN repeat('presbytery of ', {BROKEN}) || text ELSE {PUT} || text END AS repaired FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)),
lexicon AS ({LEXICON} UNION SELECT * FROM (VALUES ('presbytery'), {SHORT})), w AS (SELECT doc_id, false AS again, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM d UNION ALL SELECT doc_id, true, unnest(regexp_extract_all(lower(repaired), '[a-z]+')) FROM d),
r AS (SELECT doc_id, again, count(lexicon.word)::DOUBLE / count(*) AS rate FROM w LEFT JOIN lexicon USING (word) GROUP BY ALL),
m AS (SELECT doc_id, {FRAGMENT} AS frag, coalesce(a.rate, 1.0)::DOUBLE AS hit, coalesce(b.rate, 1.0)::DOUBLE AS after FROM d LEFT JOIN (SELECT * FROM r WHERE NOT again) a USING (doc_id) LEFT JOIN (SELECT * FROM r WHERE again) b USING (doc_id))
SELECT doc_id, hit AS hit_rate, CASE WHEN frag >= 0.25::DOUBLE THEN after ELSE hit END AS despaced_rate, CASE WHEN frag >= 0.25::DOUBLE AND after >= 0.5::DOUBLE THEN 'despace' WHEN hit < 0.4::DOUBLE AND CASE WHEN frag >= 0.25::DOUBLE THEN after ELSE hit END < 0.5::DOUBLE THEN 'reocr' ELSE 'good' END AS verdict FROM m""")
def verdicts_after_repair(spark, d):
    """QC-4: whole documents, a third with a broken word for each 24 characters of them that repair recovers, a third with as many that it does not."""
    put = PUT.replace(BROKEN, "int(6 + length(text) div 24)")
    text = docs(spark, d).select("doc_id", F.coalesce("text", lit("")).alias("text")).select("doc_id", F.expr(f"{put} || text").alias("text"))
    words = table(spark, d, "benchmark").select(F.explode(quality.word_tokens(col("text"))).alias("word")).unionByName(spark.createDataFrame([("presbytery",)], "word string")).distinct()
    return quality.classify(text, "doc_id", "text", words, TERMS, REPAIR).select("doc_id", "hit_rate", "despaced_rate", "verdict")


@query("SELECT doc_id, source, sha256(text) AS digest FROM documents WHERE source = 'src1'")
def pinned_rows(spark, d):
    """QC-5, FN-19: rows whose content has the pinned digest pass; another digest is an error."""
    pinned = quality.check_pin(docs(spark, d).filter("source = 'src1'"), "source", "8bdeed469ebb9e203abcf01af0bdd3cc4341b1338aa74af325626af4915518f8")
    return pinned.select("doc_id", "source", F.sha2("text", 256).alias("digest"))


@query("SELECT 'n' || c_nationkey AS vol, c_custkey, c_name FROM customer")
def volume_files_scan(spark, d):
    """SRC-2: a file of JSON lines for each nation; the volume is in the file's name."""
    path = folder(spark, "volumes")
    line = F.to_json(F.struct("c_custkey", "c_name"))
    each = table(spark, d, "customer").select(F.concat(lit("n"), col("c_nationkey").cast("string")).alias("slug"), line.alias("page"))
    sinks.write_pages(each.groupBy("slug").agg(F.array_join(F.collect_list("page"), "\n").alias("page")), path, suffix=".pages.jsonl")
    return readers.volume_files(spark, f"{path}/*.pages.jsonl", "c_custkey long, c_name string").select("vol", "c_custkey", "c_name")


@query("""SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS row_id FROM orders""")
def scanned_row_ids(spark, d):
    """SRC-6, WIN-4: orders in files, numbered in the order of files and rows."""
    path = folder(spark, "orders")
    table(spark, d, "orders").select("o_orderkey", "o_orderpriority").repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey").write.json(path)
    return readers.with_sequence(spark.read.schema("o_orderkey long, o_orderpriority string").json(path)).select("o_orderkey", col("_seq").alias("row_id"))


@query("""SELECT c_custkey::VARCHAR AS key, CASE WHEN c_custkey IN (1, 2, 3) THEN 'new ' || c_custkey ELSE c_name END AS value FROM customer UNION ALL SELECT 'rows', (SELECT count(*) FROM customer)::VARCHAR""")
def loaded_and_set(spark, d):
    """SNK-1, SNK-3: a table loaded anew, then settings put over and beside its rows."""
    name, c = f"foliant_{uuid.uuid4().hex}", table(spark, d, "customer")
    rows = c.select(col("c_custkey").cast("string").alias("key"), col("c_name").alias("value"))
    sinks.load_table(rows.limit(1), name)
    n = sinks.load_table(rows, name, ["key"])
    sinks.upsert_meta(spark, name, {"1": "new 1", "2": "new 2", "3": "new 3", "rows": str(n)})
    return spark.table(name)


@query("""SELECT 'ga' || (n_nationkey + 1) || '_1990__o' || c_custkey AS slug, '# GA' || (n_nationkey + 1) || ' O' || c_custkey || ' — ' || CASE WHEN c_custkey % 4 = 0 THEN '(untitled overture)' ELSE 'On ' || c_mktsegment END || chr(10) || chr(10)
|| '**Assembly:** ' || (n_nationkey + 1) || CASE WHEN (n_nationkey + 1) BETWEEN 11 AND 20 THEN 'th' WHEN (n_nationkey + 1) % 10 = 1 THEN 'st' WHEN (n_nationkey + 1) % 10 = 2 THEN 'nd' WHEN (n_nationkey + 1) % 10 = 3 THEN 'rd' ELSE 'th' END || ' (1990) · **Source:** ' || n_name || ' Presbytery'
|| CASE WHEN c_custkey % 3 = 0 THEN ' · **Disposition:** Approved & ratified · **Ratified** · **BCO:** 9-3, 21-' || n_nationkey ELSE '' END || chr(10) || chr(10) || '*Source: [ga' || (n_nationkey + 1) || '_1990 p. ' || (c_custkey % 300) || '](../markdown/ga' || (n_nationkey + 1) || '_1990.md#ga' || (n_nationkey + 1) || '-p' || (c_custkey % 300) || ')*'
|| chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'An overture of ' || c_name || chr(10) || chr(10) || 'Whereas it is so, and' || chr(10) || chr(10) || 'Therefore be it done.' || chr(10) || chr(10) || '---' || chr(10) || chr(10) || '[← Overture catalogue](../index/OVERTURES.md)' AS page
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def overture_page_files(spark, d):
    """SNK-5, JN-3, WIN-6, QC-17, REP-7: pages of overtures, each with a longer body from an index that is not taken, written as files and read again."""
    path, k, ga = folder(spark, "overtures"), col("c_custkey"), col("n_nationkey") + 1
    c = table(spark, d, "customer").join(table(spark, d, "nation"), col("c_nationkey") == col("n_nationkey")).withColumn("vol", F.concat(lit("ga"), ga.cast("string"), lit("_1990")))
    body = lambda seq, text: c.select("vol", k.alias("number"), ga.alias("ga"), (k % 300).alias("pdf_page"), F.concat("n_name", lit(" Presbytery")).alias("source"), text.alias("body"), lit(seq).alias("_seq"))
    bodies = body(1, F.concat(lit("An overture of "), "c_name", lit(" Whereas it is so, and Therefore be it done."))).unionByName(body(2, F.concat(F.repeat(lit("PART V INDEX "), lit(20)), "c_name")))
    titles = c.filter(k % 4 != 0).select("vol", k.alias("number"), F.concat(lit("On "), "c_mktsegment").alias("title"), lit(1).alias("_seq"))
    bco = F.array(lit("9-3"), F.concat(lit("21-"), col("n_nationkey").cast("string")))
    said = c.filter(k % 3 == 0).select("vol", k.alias("number"), lit("Approved").alias("disposition"), lit("Approved & ratified").alias("final"), lit(True).alias("ratified"), bco.alias("bco"), lit("").alias("note"), lit(1).alias("_seq"))
    sinks.write_pages(builds.overture_pages(bodies, titles, said), path)
    return sinks.read_pages(spark, path)
