"""Every operator that no query over the driver's tables covers, on small frames with known results."""

import hashlib

import pytest
from pyspark.sql import functions as F

from foliant.functions import text as fn
from foliant.operators import audit, catalogue, hierarchy, joins, lifecycle, parsing, quality, repair, search
from foliant.sources import readers, sinks
from foliant.streaming import state


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def lines(spark, text, vol="v"):
    return readers.lines(spark.createDataFrame([(vol, text)], "vol string, text string"), "vol")


# Sources


def test_volume_files_take_their_name(spark, tmp_path):
    (tmp_path / "ga01_1973.pages.jsonl").write_text('{"pdf_page": 1, "text": "a", "vol": "wrong"}\n{"pdf_page": 2}\n')
    (tmp_path / "ga02_1974.pages.jsonl").write_text('{"pdf_page": 1, "text": "b"}\n')
    got = readers.volume_files(spark, f"{tmp_path}/*.pages.jsonl")
    assert rows(got, "vol", "pdf_page", "text") == [("ga01_1973", 1, "a"), ("ga01_1973", 2, None), ("ga02_1974", 1, "b")]


def test_json_documents_and_maps(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": "x", "n": 1},\n {"k": "y"}]')
    assert rows(readers.json_document(spark, f"{tmp_path}/a.json", "k string, n int"), "k", "n") == [("x", 1), ("y", None)]
    assert readers.json_document(spark, f"{tmp_path}/none.json", "k string").count() == 0
    (tmp_path / "m.json").write_text('{"1990-1": {"t": "u"}, "1990-2": null}')
    assert rows(readers.json_map(spark, f"{tmp_path}/m.json", "struct<t:string>").select("key", "value.t"), "key", "t") == [("1990-1", "u"), ("1990-2", None)]


def test_sequence_anchors_rosters_and_reader(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert [r.k for r in readers.with_sequence(frame, "k").orderBy("_seq").collect()] == ["a", "b", "c"]
    assert rows(readers.anchors(lines(spark, '<a id="ga1-p7"></a>x\n<a id="ga1-pB"></a>\n<a id="ga1-p8">')), "line_no", "page") == [(1, 7), (3, 8)]
    roster = spark.createDataFrame([("1990-1", "t", True, 1990), ("1991-1", "u", False, 1991)], "case_number_raw string, title string, has_pdf boolean, year int")
    assert rows(readers.roster_of_year(roster, 1991), "case_number_raw", "has_pdf") == [("1991-1", False)]

    def reader(vol, page):
        if page == 2:
            raise ValueError("no page")
        return f"{vol}:{page}"

    pages = spark.createDataFrame([("v", 1), ("v", 2)], "vol string, pdf_page int")
    assert rows(readers.recognise(pages, reader), "pdf_page", "status", "new_text") == [(1, "ok", "v:1"), (2, "error: no page", None)]


def test_keyed_links_keep_the_last(spark):
    html = '<a href="cases/1990-08.pdf">A v. B</a><a href="other.pdf">no</a><a href="cases/1990-8x.pdf" target=_b> New </a><a href="cases/1991-02.pdf">C</a>'
    got = readers.keyed_links(spark.createDataFrame([(html,)], "html string"), "html")
    assert rows(got, "key", "raw", "year", "title") == [("1990-8", "1990-08", 1990, "A v. B"), ("1990-8x", "1990-8x", 1990, "New"), ("1991-2", "1991-02", 1991, "C")]


# Sinks


def test_tables_meta_and_backups(spark, tmp_path):
    frame = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    try:
        assert sinks.load_table(frame, "foliant_t", ["k"]) == 2 and sinks.load_table(frame.limit(1), "foliant_t") == 1
        sinks.upsert_meta(spark, "foliant_none", {"a": "1"})
        assert not spark.catalog.tableExists("foliant_none")
        sinks.load_table(spark.createDataFrame([("a", "1"), ("b", "1")], "key string, value string"), "foliant_meta")
        sinks.upsert_meta(spark, "foliant_meta", {"b": "2", "c": "3"})
        assert rows(spark.table("foliant_meta"), "key", "value") == [("a", "1"), ("b", "2"), ("c", "3")]
    finally:
        for t in ("foliant_t", "foliant_meta"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
    sinks.backup_once(frame, f"{tmp_path}/b")
    sinks.backup_once(frame.limit(0), f"{tmp_path}/b")
    assert spark.read.parquet(f"{tmp_path}/b").count() == 2


def test_pages_listings_packs_and_reports(spark, tmp_path):
    frame = spark.createDataFrame([("o1", "T", "a", None, "body"), ("o2", "U", "", "b", "more")], "slug string, t string, m string, n string, b string")
    paged = frame.withColumn("page", sinks.page(F.col("t"), [F.col("m"), F.col("n")], F.col("b"), F.lit("src")))
    assert paged.orderBy("slug").first()["page"] == "# T\n\na\n\nsrc\n\nbody\n\n[Index](../INDEX.md)"
    sinks.write_pages(paged, f"{tmp_path}/p")
    sinks.write_pages(paged.filter("slug = 'o2'"), f"{tmp_path}/p")  # the old tree goes
    assert [f.name for f in (tmp_path / "p").iterdir()] == ["o2.md"] and (tmp_path / "p/o2.md").read_text().startswith("# U\n\nb\n\nsrc")
    assert rows(sinks.grouped_listing(frame, "m", F.concat(F.lit("- "), "t"), ["t"]), "text") == [("## \n- U",), ("## a\n- T",)]
    parts = [("one", frame.select(F.col("b").alias("text"), F.lit(1).alias("n"))), ("two", spark.createDataFrame([("z", 2), ("y", 10), ("x", 1)], "text string, n int"))]
    assert [r.text for r in sinks.pack(parts, order="n").collect()] in (["body", "more", "x", "z", "y"], ["more", "body", "x", "z", "y"])
    assert [r.text for r in sinks.pack(parts).collect()] == ["body", "more", "x", "y", "z"]
    assert [tuple(r) for r in sinks.report(frame.unionByName(frame.limit(1)), "slug").collect()] == [("o1", 2), ("o2", 1)]
    raw = sinks.with_raw(frame, ["slug"], ["m", "n"]).orderBy("slug").collect()
    assert [r.url for r in raw] == ["a", "b"] and raw[0].raw.startswith('{"slug":"o1","t":"T"')


def test_json_array_refuses_large_tables(spark, monkeypatch):
    monkeypatch.setattr(sinks, "WHOLE", 2)
    with pytest.raises(ValueError, match="write_json_lines"):
        sinks.json_array(spark.range(3), ["id"])


def test_source_lines_become_pages(spark):
    src = spark.createDataFrame([("v", 1, "Source: lines 3-12"), ("v", 2, "Source: lines 1-4"), ("v", 3, "text"), ("w", 1, "Source: lines 1-2")], "vol string, line_no int, line string")
    points = spark.createDataFrame([("v", 2, 10), ("v", 10, 11)], "vol string, line_no int, page int")
    got = joins.rewrite_sources(src, points)
    assert rows(got, "vol", "line_no", "line", "unmapped") == [("v", 1, "Source: pp. 10–11", False), ("v", 2, "Source: p. 10", False), ("v", 3, "text", False), ("w", 1, "Source: lines 1-2", True)]


# Quality


def test_pins_locations_volumes_and_blocks(spark):
    frame = spark.createDataFrame([("abc",)], "content string")
    assert quality.check_pin(frame, "content", hashlib.sha256(b"abc").hexdigest()).count() == 1 and quality.check_pin(frame, "content", None).count() == 1
    with pytest.raises(Exception, match="pinned"):
        quality.check_pin(frame, "content", "0").collect()
    hits = spark.createDataFrame([(1, 0), (0, 2), (0, 1), (0, 0)], "c int, l int")
    assert [r[0] for r in hits.select(quality.strong_location(F.col("c"), F.col("l"))).collect()] == [True, True, False, False]
    vols = spark.createDataFrame([(0, 2, 3, 0.7, 0), (0, 2, 8, 0.1, 15), (1, 0, 9, 1.0, 20), (0, None, 9, 1.0, 20), (0, 3, 9, 1.0, 20), (0, 0, 2, 1.0, 14), (None, 0, 3, 0.9, 0)], "j int, o int, b int, r double, n int")
    assert [r[0] for r in vols.select(quality.acceptable(*map(F.col, "jobrn"))).collect()] == [True, True, False, False, False, False, True]
    old = spark.createDataFrame([("short", ["1980-1", "1981-2"], 1990), ("short", ["1980-1", "1988-2"], 1990), ("short", [], 1990), ("x" * 1000, ["1980-1"], 1990)], "t string, n array<string>, y int")
    assert [r[0] for r in old.select(quality.short_and_old(F.col("t"), F.col("n"), F.col("y"))).collect()] == [True, False, False, False]


def test_mislocation_guard_and_motions(spark):
    guard = lambda body, prov: spark.createDataFrame([(body, ["1990-1"], ["Bowen"], prov)], "b string, n array<string>, p array<string>, v string").select(quality.contains_case(*map(F.col, "bnpv"))).first()[0]
    assert guard("we heard bowen at length", "sjc_decision") and not guard("nobody", "sjc_decision") and guard("x" * 2001, "sjc_decision")
    assert guard("Case 1990-1\ntext", "hunt") and not guard("a mention of Bowen in a sentence", "hunt") and guard("## Complaint of Bowen", None)
    assert [one(spark, t, quality.reads_like_motion) for t in ("WHEREAS the", "Be it resolved", "index 12", "now therefore")] == [True, True, False, True]


def test_reread_candidates_pass_every_test(spark):
    words = " ".join(f"word{'aeiou'[k % 5]}{chr(98 + k % 20)}" for k in range(60))
    known = sorted(set("".join(c if c.isalpha() else " " for c in words.lower()).split()))
    broken = words.replace(" ", " b ", 6)
    pages = spark.createDataFrame([("a", broken, 1990), ("b", broken, 2010), ("c", words, 1990), ("d", "b c d f g h", 1990), ("e", None, 1990)], "k string, t string, y int")
    lexicon = spark.createDataFrame([(w,) for w in known], "word string")
    got = quality.reread_candidates(pages, "k", "t", "y", lexicon)
    assert rows(got, "k", "strays") == [("a", 6)]


def test_classify_despaces_only_what_is_broken(spark):
    lexicon = spark.createDataFrame([(w,) for w in ("the", "church", "of", "god")], "word string")
    pages = spark.createDataFrame([("a", "the c h u r c h of god"), ("b", "the church of god"), ("c", "zzz yyy xxx"), ("d", "q w e r t zz")], "k string, t string")
    got = quality.classify(pages, "k", "t", lexicon, {"common": ["church"]})
    assert rows(got, "k", "verdict") == [("a", "despace"), ("b", "good"), ("c", "reocr"), ("d", "reocr")]
    assert got.filter("k = 'a'").first().despaced_rate == 1.0


def test_hit_rates_alike_with_and_without_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "the the cat"), (2, ""), (3, None), (4, "pca zz")], "k int, t string")
    lexicon = spark.createDataFrame([("the",), ("the",)], "word string")
    want = [(1, 3, 2 / 3), (2, 0, 1.0), (3, 0, 1.0), (4, 2, 0.5)]
    assert rows(quality.hit_rates(docs, "k", "t", lexicon), "k", "n_tokens", "hit_rate") == want
    monkeypatch.setattr(quality, "SMALL", 1)
    assert rows(quality.hit_rates(docs, "k", "t", lexicon), "k", "n_tokens", "hit_rate") == want


# Repair


TERMS = {"phrase": ["General Assembly"], "common": ["church", "presbytery"], "name": ["roberts"], "shifted": ["church in"]}


@pytest.mark.parametrize("text, want", [
    ("the Gen eral Ass embly met", "the General Assembly met"), ("THE GEN ERAL ASS EMBLY", "THE GENERAL ASSEMBLY"), ('a "ch urch," old', 'a "church," old'), ("Ch urch", "Church"),
    ("Rob erts and rob erts", "Roberts and rob erts"), ("Robert S. went", "Robert S. went"), ("ch 4 urch", "ch 4 urch"), ("the ch urchin", "the church in"), ("church in", "church in"),
    ("presb yt\nery  x", "presbytery  x"), ("", ""), ("chu’rch ch*urch", "chu’rch ch*urch"),
])
def test_despacer(text, want):
    assert repair.despacer(TERMS)(text) == want


def test_despacer_corrects_whole_words_first_and_goes_on_until_nothing_changes():
    fix = repair.despacer({"common": ["church", "churchmen"]}, {"rnen": "men", "a.b": "ch"})
    assert fix("ch urch rnen and rnens") == "churchmen and rnens" and fix("a.b urch axb") == "church axb"
    assert repair.despacer({"common": ["abc", "abcde"]}, rounds=1)("ab c d e") == "abcde" and repair.despacer({"common": ["ab", "abcd"]})("a b c d") == "abcd"


def test_despace_leaves_later_years_alone(spark):
    frame = spark.createDataFrame([(1, "ch urch", 2002), (2, "ch urch", 2003), (3, "ch urch", None), (4, None, 1990)], "k int, t string, y int")
    assert rows(repair.despace(frame, "t", TERMS, year="y"), "k", "t") == [(1, "church"), (2, "ch urch"), (3, "ch urch"), (4, None)]


def test_labels_paragraphs_and_noise(spark):
    assert one(spark, "x\n**Dissenting Opinion of A**\n OPINION OF THE COURT\nDecision was", repair.promote_labels) == "x\n#### Dissenting Opinion of A\n#### OPINION OF THE COURT\nDecision was"
    assert one(spark, "a  Whereas b; Be it c whereas d", repair.clause_paragraphs) == "a\n\nWhereas b;\n\nBe it c whereas d"
    assert one(spark, ["a", "<!-- PAGE x", "12 MINUTES OF THE GENERAL ASSEMBLY"], repair.drop_noise, "array<string>") == ["a"]
    assert one(spark, "<a id='x'></a>**b**  `c`<!-- d -->", repair.strip_markup) == "b c"


# Parsing


def test_page_splitter_and_ranges(spark):
    text = lines(spark, '<!-- PAGE ga=1 pdf_page=4 -->\none\n<a id="ga1-p4"></a>\ntwo\n<!-- PAGE ga=1 pdf_page=5 -->\nthree\n<!-- PAGE ga=1 pdf_page=cover -->\nfour')
    assert rows(parsing.page_of_lines(text), "line", "pdf_page") == [('<a id="ga1-p4"></a>', 4), ("four", None), ("one", 4), ("three", 5), ("two", 4)]
    spans = spark.createDataFrame([("s", "v", 4, 5), ("t", "v", 5, 9)], "id string, vol string, start int, end int")
    assert rows(parsing.page_range(text, spans), "id", "text") == [("s", "one\ntwo\nthree"), ("t", "three")]


def test_overture_bodies_stop_at_headings_disposals_and_ends(spark):
    text = lines(spark, "## Overture 1 from Ascension\nWhereas a\n12 MINUTES OF THE GENERAL ASSEMBLY\nb\n## Overture 2 From *Calvary*\nc\n1. That Overture 2 be answered\nd\n2. That overture 9 be\ne")
    got = parsing.overture_bodies(text)
    assert rows(got, "number", "source", "body") == [(1, "Ascension", "Whereas a b"), (2, "Calvary", "c 1. That Overture 2 be answered d")]
    ends = spark.createDataFrame([("v", 5, 6)], "vol string, line_no int, last_line int")
    assert rows(parsing.overture_bodies(text, ends), "number", "body") == [(1, "Whereas a b"), (2, "c")]


def test_overtures_are_detected_but_index_rows_are_not(spark):
    text = lines(spark, '## Overture 3 from X "Amend BCO 9"\n## Overture 4\nfrom Y\n## Overture 5 from Z ..... 12\n## Overture 6 from Z 12\n## Overture 7\nno source')
    assert rows(parsing.detect_overtures(text), "number", "quoted") == [(3, "Amend BCO 9"), (4, "")]


def test_roster_lines_wrap_and_fold(spark):
    text = readers.lines(spark.createDataFrame([("p", "Jump links\n1990-08 Bowen v. Eastern Presbytery, M18GA, p. 120.\n1990-9\nSmith v. Jones.\n1991-__ A\nSummary: long story\nCopyright x")], "page string, text string"), "page")
    got = parsing.roster_rows(text)
    assert rows(got, "number", "year", "title") == [("1990-08", 1990, "Bowen v. Eastern Presbytery, M18GA, p. 120"), ("1990-9", 1990, "Smith v. Jones — Smith v. Jones."), ("1991-__", 1991, "A — Summary: long story")]
    assert rows(got, "citation")[0] == ("M18GA, p. 120",)


def test_yearly_changes(spark):
    got = one(spark, "1990 - BCO 9-3, 10-1.a became new; RAO 4-2. 1991 - No revisions adopted, 3-1. 1992 - Chapters 5 & 6, Preface", parsing.yearly_changes)
    assert [(r.year, r.sections, r.renumbering) for r in got] == [(1990, ["10-1.a", "9-3"], True), (1991, [], False), (1992, ["Chapters 5 & 6", "Preface"], False)]


def test_locators_people_and_parties(spark):
    assert tuple(one(spark, "x [M26GA (1998): 222-227]. Sustained", parsing.locator)) == (26, 222, 227) and tuple(one(spark, "M. 9 GA (1981): 50", parsing.locator)) == (9, 50, 50) and one(spark, "none", parsing.locator) is None
    got = one(spark, "Complaint of TE Rev. John O'Neil and the Session vs. Westminster Presbytery", parsing.parties)
    assert (got.lead, got.court) == (["john", "o'neil"], ["westminster"])
    assert one(spark, "TE Mr. John Bowen, et al v. Eastern Presbytery", parsing.person_tokens) == ["John", "Bowen"]
    assert one(spark, "The Appeal of Bowen, Ruling Standing Ford Kent Webb", parsing.surnames) == ["Bowen", "Ruling", "Ford"]


def test_trim_to_next_case(spark):
    text = "intro\nCASE 1990-1 Bowen v. East\n" + "body text goes on here and on\n" * 3 + "Case 1990-2 Smith v. West\nother"
    frame = lines(spark, text).withColumn("nx", F.lit("(?i)smith"))
    got = parsing.trim_to_next(frame, "vol", "(?i)^case 1990-1", "nx").first()["text"]
    assert got.startswith("CASE 1990-1") and got.endswith("on") and "Smith" not in got
    short = lines(spark, "Case 1990-1\nCase 1990-2 Smith\nx").withColumn("nx", F.lit("(?i)smith"))
    assert parsing.trim_to_next(short, "vol", "(?i)^case 1990-1", "nx").first()["text"] == "Case 1990-1\nCase 1990-2 Smith\nx"


def test_slices_join_spans_in_order(spark):
    spans = spark.createDataFrame([("a", "v", 2, 3, 3), ("a", "v", 1, 1, 2), ("b", "v", 1, 0, 2), ("b", "v", 2, 4, 9)], "id string, vol string, span_no int, a int, b int")
    assert rows(parsing.slices(lines(spark, 'one\ntwo\n<a id="x"></a>three\nfour'), spans), "id", "text") == [("a", "one\ntwo\n\nthree"), ("b", "four")]


def test_captions_and_disposing_sentences(spark):
    text = lines(spark, "12. Case No. 90-8. Bowen v. Eastern Presbytery [M18]...\n1990-8 Bowen\n1990-8: Complaint of Bowen vs. all of Eastern Presbytery.\nCase 1990-8 was found\nadministratively out of order.\nCase 90-8 was dismissed")
    cases = spark.createDataFrame([("c", "v", "1990-8")], "id string, vol string, number string")
    assert rows(parsing.captions(text, cases), "caption") == [("Complaint of Bowen vs. all of Eastern Presbytery",)]
    asked = spark.createDataFrame([("c", "v", ["1990-8", "90-8"], 4), ("d", "v", ["1990-8", "90-8"], 6)], "id string, vol string, numbers array<string>, region_from int")
    assert rows(parsing.disposing_sentences(text, asked), "id", "line_no", "disposition") == [("c", 6, "Dismissed"), ("d", 6, "Dismissed")]


@pytest.mark.parametrize("title, want", [("A v. B [M18] Sustained in part 16-0", "sustained_in_part"), ("denied [x] see below", "denied"), ("judicially out of order", "out_of_order"), ("A v. B", None)])
def test_title_dispositions(spark, title, want):
    assert one(spark, title, parsing.title_disposition) == want


def test_disposition_labels_keep_long_phrases(spark):
    assert one(spark, "x" * 3000, parsing.disposition_label) == "X" + "x" * 2999


@pytest.mark.parametrize("title, want", [
    ("APPENDIX B REPORT OF THE AD INTERIM COMMITTEE ON WOMEN IN MINISTRY TO THE 45TH GENERAL ASSEMBLY", "WOMEN IN MINISTRY"),
    ("REPORT OF THE PCA GENERAL ASSEMBLY OF THE STUDY COMMITTEE TO STUDY AND MAKE RECOMMENDATIONS AS TO DIVORCE", "DIVORCE"),
    ("REPORT BY THE COMMITTEE TO STUDY FREEMASONRY OF THE PRESBYTERIAN CHURCH IN AMERICA", "FREEMASONRY"), ("MINORITY REPORT OF COMMITTEE ON GOD", "GOD"), ("CREATION", "CREATION"),
])
def test_report_topics(spark, title, want):
    assert one(spark, title, parsing.report_topic) == want


def test_previews_and_section_blocks(spark):
    got = spark.createDataFrame([(["a", "", "<a id=x>", "b", "c", "d"],)], "l array<string>").select(parsing.preview(F.col("l"), F.lit(1), F.lit(5), 2).alias("p")).first()["p"]
    assert got == "b\nc"
    assert one(spark, "## A\nx\n### B\ny\n## C\nz", lambda c: parsing.section_block(c, "## A")) == "## A\nx\n### B\ny" and one(spark, "## A\nx", lambda c: parsing.section_block(c, "## Q")) == ""


# Joins


def test_first_match_in_list(spark):
    left = spark.createDataFrame([(1, "v", ["x", "y"]), (2, "v", ["z"])], "id int, vol string, keys array<string>")
    right = spark.createDataFrame([("v", "y", "Y"), ("v", "x", "X"), ("w", "z", "Z")], "vol string, element string, title string")
    assert rows(joins.first_match_in_list(left, right, "id", "keys", ["vol"], "title", "t"), "id", "t") == [(1, "X"), (2, None)]


def test_titles_and_dispositions_by_number_as_text(spark):
    bodies = spark.createDataFrame([("v", 1, 5), ("v", 2, 6)], "vol string, number int, pdf_page int")
    titles = spark.createDataFrame([("v", "1", "old", 1), ("v", "1", "new", 2)], "vol string, number string, title string, _seq int")
    disps = spark.createDataFrame([("v", "1", 5, "yes", 1), ("v", "1", 9, "no", 2)], "vol string, number string, pdf_page int, disposition string, _seq int")
    assert rows(joins.with_titles(bodies, titles, disps), "number", "title", "disposition") == [(1, "new", "no"), (2, None, None)]
    assert rows(joins.with_titles(bodies, titles, disps, page=True), "number", "disposition") == [(1, "yes"), (2, None)]


def test_relink_counts_null_years_as_zero(spark):
    missing = spark.createDataFrame([("m", ["bowen"], 1990), ("n", ["bowen"], None)], "key string, lead array<string>, year int")
    cases = spark.createDataFrame([("far", ["bowen"], 1994, 1), ("near", ["x", "bowen"], 1987, 3), ("later", ["bowen"], 1993, 2), ("none", ["bowen"], None, 9)], "case_id string, lead array<string>, year int, _seq int")
    assert rows(joins.relink(missing, cases), "key", "relink") == [("m", "later"), ("n", "none")]


def test_merge_decides_by_names_and_courts(spark):
    kind = "case_id string, keys array<string>, lead array<string>, court array<string>, _seq int"
    own = spark.createDataFrame([("a", ["1990-1", "90-1"], ["bowen", "ford"], ["east"], 1), ("b", ["1990-2"], ["smith"], ["west"], 2)], kind)
    found = spark.createDataFrame([("x", ["1990-1"], ["bowen"], [], 1), ("y", ["1990-2"], ["smith"], ["north"], 2), ("z", ["1990-3"], ["kent"], [], 3), ("w", ["90-1"], ["other"], ["east"], 4)], kind)
    assert rows(joins.merge_found(own, found), "new_id", "case_id", "action") == [("w", "a", "demote_and_insert"), ("x", "a", "skip"), ("y", "b", "demote_and_insert"), ("z", None, "insert")]


def test_cells_overtures_and_blocks_by_section(spark):
    targets = spark.createDataFrame([("9-3",), ("21-1",)], "section string")
    cells = spark.createDataFrame([(1, "BCO 9-3 and 19-3"), (2, "9-33, 9-3-1"), (3, None)], "id int, cell string")
    assert rows(joins.cells_citing(cells, "id", "cell", targets), "id", "section") == [(1, "9-3")]
    bodies = spark.createDataFrame([("a", "see 9-3"), ("b", "none")], "key string, body string")
    titles = spark.createDataFrame([("a", "x"), ("b", "21-1"), ("c", "9-3 9-3")], "key string, title string")
    assert rows(joins.overtures_citing(bodies, titles, targets), "key", "matched_by") == [("a", "body"), ("b", "title"), ("c", "title")]
    blocks = spark.createDataFrame([("BCO 9-3", "x"), ("RAO 9-3", "y")], "heading string, t string")
    asked = spark.createDataFrame([("BCO 9-3",)], "section string")
    assert rows(joins.blocks_of(blocks, asked), "t") == [("x",)] and rows(joins.blocks_of(blocks, asked, kinds=False), "t") == [("x",), ("y",)]


def test_case_files_and_search_details(spark):
    files = spark.createDataFrame([("a.md", ["1990-08", "98-9b"]), ("b.md", ["1990-8"])], "file string, numbers array<string>")
    assert rows(joins.files_of_cases(files), "number", "file") == [("1990-8", "b.md"), ("1998-9", "a.md")]
    details = spark.createDataFrame([("1990-8", ["BCO 9", "BCO 1"], " ", 1), ("1998-9b", ["BCO 9"], "denied", 2)], "number string, provisions array<string>, disposition string, _seq int")
    got = joins.search_details(files, details)
    assert rows(got, "file", "provisions", "disposition") == [("a.md", ["BCO 1", "BCO 9"], "denied"), ("b.md", ["BCO 1", "BCO 9"], None)]


def test_reconcile_reports_its_coverage(spark):
    roster = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "alias_id int, alias string")
    docs = spark.createDataFrame([(10,), (11,)], "doc_id int")
    gaps, extra, cover = joins.reconcile(roster, spark.createDataFrame([(1, 10), (2, 10)], "alias_id int, doc_id int"), docs, "doc_id")
    assert rows(gaps, "alias_id") == [(3,)] and rows(extra, "doc_id") == [(11,)] and tuple(cover.first()) == (3, 2, 1, 1)
    body = spark.createDataFrame([("1990-1", "t")], "case_number string, title string")
    assert rows(joins.only_listed(body, spark.createDataFrame([("1990-1",), ("1990-2",)], "case_number string")), "case_number", "source") == [("1990-1", "body"), ("1990-2", "pdf_only")]


def test_cites_and_catalogue_cells_become_links(spark):
    docs = spark.createDataFrame([(1, "GA51 O12, [GA51 O12](x), GA51 O1 and GA9 O9"), (2, None)], "id int, t string")
    pages = spark.createDataFrame([("GA51 O12", "o12.md"), ("GA51 O1", "o1.md")], "cite string, path string")
    assert rows(joins.link_cites(docs, "id", "t", pages), "id", "t") == [(1, "[GA51 O12](o12.md), [GA51 O12](x), [GA51 O1](o1.md) and GA9 O9"), (2, None)]
    cells = spark.createDataFrame([("v", "12"), ("v", "[3](old.md)"), ("v", "x")], "vol string, cell string")
    where = spark.createDataFrame([("v", 12, "a.md"), ("v", 3, "b.md")], "vol string, number int, path string")
    assert rows(joins.link_catalogue(cells, where), "cell") == [("[12](a.md)",), ("[3](b.md)",), ("x",)]


def test_windows_volumes_and_years(spark):
    cand = spark.createDataFrame([("c", 1, "v", 1), ("c", 4, "w", 50)], "case_id string, rank int, vol string, pdf_page int")
    assert rows(joins.page_windows(cand, 1, 2), "vol", "pdf_page") == [("v", 1), ("v", 2), ("v", 3)]
    cases = spark.createDataFrame([("ga30_2002:7", 1), ("x:1", 9), ("x:2", 99)], "case_id string, ga_ordinal int")
    vols = spark.createDataFrame([(9, "ga09_1981"), (1, "ga01_1973")], "ga_ordinal int, vol string")
    assert rows(joins.volume_of_case(cases, vols), "case_id", "vol") == [("ga30_2002:7", "ga30_2002"), ("x:1", "ga09_1981"), ("x:2", None)]
    changes = spark.createDataFrame([(1990, ["9-3"]), (1991, ["19-3"]), (1989, ["Chapter 9"]), (1992, ["Chapters 5 & 9"])], "year int, sections array<string>")
    assert [r.year for r in joins.years_amended(changes, "9").collect()] == [1989, 1990, 1992]


def test_ordered_aggregates(spark):
    frame = spark.createDataFrame([("k", 3, "b", ["y"]), ("k", 1, "a", ["x", "y"]), ("k", 2, "b", None), ("k", 4, None, [])], "k string, n int, v string, s array<string>")
    got = frame.groupBy("k").agg(joins.ordered_distinct("v", "n", " · ").alias("t"), joins.ordered_set_union("s").alias("u")).first()
    assert (got.t, got.u) == ("a · b", ["x", "y"])
    assert rows(joins.top_k(frame, ["k"], [F.desc("n")], 2), "n", "rank") == [(3, 2), (4, 1)]


# Threads


def test_threads_by_body_provision_and_volume(spark):
    kind = "id string, body string, dates string, provisions array<string>, vol string, finding string, year int, seq int, text string"
    frame = spark.createDataFrame([
        ("E1", "West", "May 1", ["BCO 9"], "v1", "raised", 1990, 1, "a"), ("E1", "West", "May 2", ["BCO 9", "BCO 1"], "v2", "satisfactory", 1991, 1, "b"),
        (None, "West", "May 1", ["bco 9"], "v1", "raised", 1990, 2, "c"), (None, "WEST", "may-1", ["BCO 9"], "v2", "unsatisfactory", 1992, 3, "d"), (None, "East", None, [], "v1", "raised", 1990, 4, "e"),
    ], kind)
    named = lifecycle.identity(frame)
    conf = {r.text: (r.thread, r.thread_confidence) for r in named.collect()}
    assert conf["a"] == ("E1", 1.0) and conf["c"][0] == conf["d"][0] and conf["c"][1] == 0.8 and conf["e"][1] == 0.5
    threaded = lifecycle.threads(named, ["thread", "vol"], "year", "seq", "finding").drop("vol")
    whole = lifecycle.threads(named.withColumn("who", F.lower("body")), ["thread", "who"], "year", "seq", "finding")
    assert threaded.count() == 5 and rows(lifecycle.by_body(whole, "who"), "who", "threads", "first_year", "last_year", "open") == [("east", 1, 1990, 1990, 1), ("west", 2, 1990, 1992, 1)]
    assert rows(lifecycle.by_provision(frame, "text"), "heading", "entries") == [("BCO 1 · 1 citation(s)", ["b"]), ("BCO 9 · 3 citation(s)", ["a", "b", "d"]), ("bco 9 · 1 citation(s)", ["c"])]
    assert rows(lifecycle.counts_by_volume(frame), "vol", "raised", "satisfactory", "unsatisfactory", "bodies") == [("v1", 3, 0, 0, 2), ("v2", 0, 1, 1, 2)]


# Functions


def test_numbers_volumes_and_titles(spark):
    assert [one(spark, y, fn.assembly_of_year, "int") for y in (1973, 2019, 2021)] == [1, 47, 48] and [one(spark, n, fn.year_of_assembly, "int") for n in (1, 47, 48)] == [1973, 2019, 2021]
    assert tuple(one(spark, "ga30_2002.pages", fn.volume_parts)) == (30, 2002) and tuple(one(spark, "x", fn.volume_parts)) == (0, 0)
    assert [one(spark, v, lambda c: fn.volume_name(c, {30: "ga30_2002"})) for v in ("GA30", "030", "31", "other")] == ["ga30_2002", "ga30_2002", "31", "other"]
    assert one(spark, "1990-08_Bowen_v_EasternSide", fn.spaced_title) == "Bowen v. Eastern Side" and one(spark, " a|b\nc ", fn.markdown_cell) == "a\\|b c"
    assert one(spark, "WOMEN IN PCA", lambda c: fn.display_title(c, {"Pca": "PCA"})) == "Women In PCA" and one(spark, "Mixed Case rao", lambda c: fn.display_title(c, {})) == "Mixed Case rao"
    assert one(spark, "A" + "B" * 12_000, lambda c: fn.display_title(c, {})) == "A" + "b" * 12_000
    assert [one(spark, y, fn.court_of_year, "int") for y in (1987, 1988, None)] == ["CJB", "SJC", "SJC"] and one(spark, "a b/c?", fn.safe_file_name) == "a_b_c_"


def test_labels_links_and_keys(spark):
    assert [one(spark, p, fn.page_label, "array<int>") for p in ([], [3], [3, 5, 9])] == ["see report", "p. 3", "pp. 3–9"]
    cell = spark.createDataFrame([(45, 2017), (0, 2020), (None, None)], "n int, y int").select(fn.assembly_cell(F.col("n"), F.col("y")).alias("c"))
    assert [r.c for r in cell.collect()] == ["45th (2017)", "2020", "—"]
    link = spark.createDataFrame([("http://x", "v", [1], "a"), (" ", "v", [1, 2], None)], "u string, v string, p array<int>, a string").select(fn.report_link(*map(F.col, "uvpa")).alias("l"))
    assert [r.l for r in link.collect()] == ["[external](http://x)", "[v pp. 1–2](../markdown/v.md#)"]
    assert spark.range(1).select(fn.haystack(F.lit("Ab"), F.lit("C"), F.lit(None))).first()[0] == "ab c" and one(spark, "a-1 B.", fn.letters) == "aB"
    assert [one(spark, t, fn.is_initial) for t in ("S.", "S", "St", "s")] == [True, True, False, False] and one(spark, "BCO 9-3", fn.bare) == "9-3"
    assert [one(spark, t, lambda c: fn.valid_number(c, 1, 90)) for t in (" o7", "O090", "O91", "7", "x")] == [7, 90, None, 7, None]
    order = spark.createDataFrame([("O2", 2), ("O10", 10), ("O1", None)], "id string, n int")
    assert [r.id for r in order.orderBy(fn.natural_key(F.col("id"))).collect()] == ["O1", "O2", "O10"]
    assert [r.n for r in order.orderBy(fn.string_key(F.col("n")).asc_nulls_last()).collect()] == [10, 2, None]
    assert [r.n for r in order.orderBy(fn.null_as(F.col("n"), 99)).collect()] == [2, 10, None] and [r.n for r in order.orderBy(fn.null_as(F.col("n"), 0)).collect()] == [None, 2, 10]
    assert spark.range(1).select(fn.or_else(F.lit(" "), F.lit("d"))).first()[0] == "d"


# Search, trees, audits, state


def test_one_tokeniser_persisted_postings_and_base_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "the a_b of C-3"), (2, "a c"), (3, "café au lait")], "id int, text string")
    index = search.write_postings(search.postings(docs, "id", "text"), f"{tmp_path}/i")
    find = lambda q: sorted(r.doc for r in search.search(index, q).collect())
    assert find("a_b") == [1] and find('"a b"') == [1] and find("C-3") == [1] and find("CAFÉ") == [3] and find("a") == [1, 2]
    assert rows(search.base_rows(search.search(index, "a"), docs, "id"), "id", "text") == [(1, "the a_b of C-3"), (2, "a c")]


def test_locate_scores_courts_years_and_ordinals(spark):
    docs = spark.createDataFrame([(1, "bowen eastern", 1990, 18), (2, "bowen eastern bowenite", 1999, 26), (3, "bowen western", 1990, None), (4, "eastern only", 1990, 18)], "doc int, text string, year int, ga int")
    asked = spark.createDataFrame([("k", ["bowen", "nite"], ["eastern"], 1990, 26)], "key string, lead array<string>, court array<string>, year int, ga int")
    index = search.postings(docs.withColumnRenamed("doc", "id"), "id", "text")
    got = search.locate(index, asked, docs.drop("text"))
    assert rows(got, "doc", "score", "lead_hits", "court_hits", "rank") == [(1, 5.0, 1, 1, 2), (2, 103.2, 1, 1, 1)]
    inside = search.locate(index, asked, docs)  # hits by substring
    assert rows(inside, "doc", "score", "lead_hits", "court_hits", "rank") == [(1, 5.0, 1, 1, 2), (2, 106.2, 2, 1, 1)]


def test_browse_and_union(spark):
    src = spark.createDataFrame([("Title A", ["9-3", "RAO 1"], 1990, "u/1"), ("B", [], None, "ccb/2")], "t string, p array<string>, y int, u string")
    index = catalogue.union_index(catalogue.record(src, "case", F.col("t"), F.col("u"), provisions=F.col("p"), year=F.col("y")), without=("ccb/",))
    assert rows(index, "title", "provisions", "year") == [("Title A", ["BCO 9-3", "RAO 1"], 1990)]
    assert search.browse(index, "case", "BCO 9-3", "TITLE").count() == 1 and search.browse(index, "other").count() == 0 and search.browse(index, topic="zz").count() == 0


def test_trees_have_ids_over_all_volumes(spark):
    kind = "vol string, parts array<struct<type:string,label:string,title:string,children:array<struct<type:string,label:string,title:string>>>>"
    node = lambda label, *kids: ("t", label, "", [("t", k, "") for k in kids])
    flat = hierarchy.with_ids(hierarchy.flatten(spark.createDataFrame([("b", [node("b1", "b2")]), ("a", [node("a1", "a2", "a3"), node("a4")])], kind), "parts"))
    assert rows(flat, "node_id", "parent_id", "label") == [(1, None, "a1"), (2, 1, "a2"), (3, 1, "a3"), (4, None, "a4"), (5, None, "b1"), (6, 5, "b2")]
    assert [r.label for r in hierarchy.children(flat, 1).collect()] == ["a2", "a3"] and {r.label for r in hierarchy.children(flat, None).collect()} == {"a1", "a4", "b1"}


def test_audits_of_links_numbers_stars_and_heads(spark):
    docs = spark.createDataFrame([("O1", "[1990-08 x](../markdown/a.md) 1990-99 ⭐\n⭐ GA12 GA47\n⭐ GA48 GA12"), ("O2", "title: x\nstatus: y\n## Sec\n- a\n- b")], "entity string, text string")
    files = spark.createDataFrame([("1990-8", "c.md")], "number string, file string")
    assert rows(audit.minutes_instead_of_case(docs, files), "entity", "detail") == [("O1", "1990-08 -> c.md")]
    assert rows(audit.phantom_cases(docs, files), "entity", "detail") == [("O1", "1990-99")]
    assert rows(audit.old_stars(docs), "entity", "detail") == [("O1", "⭐ GA12 GA47")]
    assert rows(audit.missing_sections(docs, ["title:", "status:"], "front_matter", head=10), "entity", "detail") == [("O1", "status:"), ("O1", "title:"), ("O2", "status:")]
    assert rows(audit.wrong_count(docs, r"(?m)^- ", 2), "entity", "kind", "detail") == [("O1", "entry_count", "0")]


def test_stale_notes_overrides_and_logs(spark, tmp_path):
    notes = spark.createDataFrame([("a", "2024-01-01"), ("b", None), ("c", "2024-05-05"), ("d", "")], "key string, seen string")
    updated = spark.createDataFrame([("a", "2024-02-01"), ("b", "2024-01-01"), ("c", "2024-05-05")], "key string, updated string")
    assert rows(state.stale(notes, updated), "key", "is_stale") == [("a", True), ("b", True), ("c", False), ("d", False)]
    changes = spark.createDataFrame([("a", "2025-01-01", 1), ("a", None, 2), ("z", "2025-02-02", 1)], "key string, updated string, _seq int")
    assert rows(state.overrides(updated, changes), "key", "updated") == [("b", "2024-01-01"), ("c", "2024-05-05"), ("z", "2025-02-02")]
    raw = spark.createDataFrame([('{"k": "a"}',), ("broken",), ("",)], "value string")
    assert rows(state.parsed_log(raw, "k string"), "k") == [("a",)]
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert state.todo(work, state.parsed_log(raw, "k string"), ["k"], 1).count() == 1
    for n in range(2):
        work.withColumn("n", F.lit(n)).write.mode("append").json(f"{tmp_path}/in")
        state.log_results(spark.readStream.schema("k string, n int").json(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6


def test_sessions(spark):
    events = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (1, "2024-01-01 00:20:00"), (1, "2024-01-01 02:00:00")], "user_id int, t string").withColumn("ts", F.to_timestamp("t"))
    assert rows(state.sessions(events), "user_id", "n") == [(1, 1), (1, 2)]


def test_as_of_clamp_is_linear_in_a_key(spark):
    left = spark.range(30_000).select(F.lit("k").alias("vol"), F.col("id").alias("line_no"))
    points = spark.createDataFrame([("k", 20_000, 7)], "vol string, at long, page int")
    assert joins.asof(left, points, ["vol"], "line_no", "at", ["page"], clamp=True).filter("page = 7").count() == 30_000


def test_overture_bodies_of_a_long_volume(spark):
    """One heading with 150,000 lines after it, blank ones too: the body is cut as the whole text would be, and few lines are collected."""
    lines = [(1, i, "## Overture 7 from Calvary" if i == 3 else "  " if i % 5 == 0 else f"word{i}  more") for i in range(150_000)]
    text = spark.createDataFrame(lines, "vol long, line_no long, line string")
    whole = " ".join(x for _, i, x in lines if i > 3).split()
    got = parsing.overture_bodies(text).collect()
    assert [(r["number"], r["line_no"], r["source"]) for r in got] == [(7, 3, "Calvary")]
    kept = " ".join(whole)[:6000]
    assert got[0]["body"] == kept[: kept.rindex(" ")] + " …"
