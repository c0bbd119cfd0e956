import bisect
import math
import random
import re
import textwrap

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliant.llm import chat, licenses, merkle, mixing, pieces, queries, repetition

from .test_exact_and_near import brute as components_of
from .test_exact_and_near import low

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF)
    want = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


TEXTS = ["", None, " ", "plain words here", "tabs\tand\nlines  two blanks ", "▁ kept", "日本語 🙂 é", "a", "word " * 4000]


def test_samples_are_distinct_decode_to_the_text_and_repeat(docs):
    rows = docs(TEXTS)
    got = pieces.decode(pieces.sample(rows, k=3)).toPandas()
    for i, own in got.groupby("doc_id"):
        assert (own["text"] == (TEXTS[i] or "")).all()
        own = own.sort_values("sample")
        assert len({tuple(x) for x in own["ids"]}) == len(own)
        assert (own["perturbed"].diff().dropna() <= 0).all() and (own["log_inclusion"] <= 1e-9).all()
    assert (got.loc[got["doc_id"] < 2, "sample"] == 0).all() and (got["doc_id"] == 3).sum() == 3
    again = pieces.sample(rows.repartition(3), k=3).toPandas()
    key = lambda f: sorted((r.doc_id, r.sample, tuple(r.ids), r.log_prob) for r in f.itertuples())
    assert key(got) == key(again) and pieces.sample(docs([])).count() == 0


def test_samples_of_a_short_text_follow_their_probabilities(docs):
    """With 'aaa', first samples come as often as their exact probabilities say."""
    n = 3000
    got = pieces.sample(docs(["aaa"] * n), k=1).toPandas()
    seen = got.groupby(got["ids"].map(tuple)).agg(p=("log_prob", "first"), n=("log_prob", "size"))
    p = seen["p"].map(lambda x: 2.718281828459045**x)
    assert p.sum() <= 1 + 1e-6 and ((seen["n"] / n - p).abs() < 4 * (p * (1 - p) / n) ** 0.5 + 1e-3).all()


def test_three_samples_follow_the_law_of_drawing_without_replacement(docs):
    """Of a small lattice: how often each ordered triple comes, and how often each segmentation is among the three, beside its inclusion score."""
    n = 3000
    got = pieces.sample(docs([(i, "aaa") for i in range(n)]), k=3).toPandas()
    p = {}
    for ids, x in zip(got["ids"].map(tuple), got["log_prob"]):
        p[ids] = math.exp(x)
    assert abs(sum(p.values()) - 1) < 1e-5 and len(p) >= 4  # all ways to write ' aaa' came up
    order = got.sort_values(["doc_id", "sample"]).groupby("doc_id")["ids"].apply(lambda x: tuple(map(tuple, x)))
    seen = order.value_counts()
    for way, count in seen.items():
        q, left = 1.0, 1.0
        for ids in way:
            q, left = q * p[ids] / left, left - p[ids]
        assert abs(count / n - q) < 5 * (q * (1 - q) / n) ** 0.5 + 2e-3
    estimate = got.assign(w=1 / got["log_inclusion"].map(math.exp)).groupby(got["ids"].map(tuple))["log_prob"].size()
    weights = got.assign(w=[math.exp(a - b) for a, b in zip(got["log_prob"], got["log_inclusion"])])
    total = weights.groupby("doc_id")["w"].sum()  # probabilities over inclusion chances add up to 1 on average
    assert len(estimate) == len(p) and abs(total.mean() - 1) < 5 * total.std() / n**0.5 + 1e-3


def test_copies_draw_samples_of_their_own_and_encode_round_trips(spark, docs):
    rows = spark.createDataFrame([(7, "some longer words in a row", c) for c in (1, 2, 3)], "doc_id long, text string, copy_no int")
    got = pieces.sample(rows, copy="copy_no").toPandas()
    assert got.columns[:2].tolist() == ["doc_id", "copy_no"] and len({tuple(x) for x in got.loc[got["sample"] == 1, "ids"]}) > 1
    plain = [t for t in TEXTS if t is None or "▁" not in t and "\t" not in t]
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs(plain))).collect()}
    assert back == {i: t or "" for i, t in enumerate(plain)}


def repeats(words, least):
    """Covered words and the longest repeat, by comparing all pairs of places."""
    n, inside, longest = len(words), set(), 0
    for a in range(n):
        for b in range(a + 1, n):
            k = 0
            while b + k < n and words[a + k] == words[b + k]:
                k += 1
            if k >= least:
                inside |= set(range(a, a + k)) | set(range(b, b + k))
                longest = max(longest, k)
    return len(inside), longest


def test_repetition_against_all_pairs(docs):
    rng = random.Random(4)
    texts = [None, "", "\n \t", "one", "l a\nl a\n\nl a\n#$ |x"] + [" ".join(rng.choice("ab") for _ in range(rng.randint(5, 60))) for _ in range(15)]
    texts += [" ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randint(20, 90))) + " same tail of seven words in all " * 2 for _ in range(15)]
    got = {r.doc_id: r for r in repetition.judge(docs(texts)).collect()}
    for i, t in enumerate(texts):
        words, lines = re.findall(r"[^\x20\x09-\x0D]+", t or ""), (t or "").split("\n")
        n, r = len(words), got[i]
        grams = [tuple(words[k : k + 8]) for k in range(n - 7)]
        again = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(8)}
        dup = sum(bool(x.split()) and x in lines[:k] for k, x in enumerate(lines))
        base = n < 20 or 100 * len(again) > 30 * n
        cover, longest = repeats(words, 5)
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (n, sum(map(len, words)), dup, len(again), base)
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t or "")) and (r.covered_words, r.longest_repeat) == (cover, longest)
        assert r.kept == (not base and cover <= 0.25 * n and longest <= 100) and sum(s.to_word - s.from_word for s in r.spans) == cover


CONV = "conv_id long, turn long, role string, text string, node string"


def check_forest(spark, rows, n_nodes=None):
    """The stream, the places and the ancestors of a forest, and the conversations read back, against a tree of dictionaries."""
    frame = spark.createDataFrame([(*r, "n") for r in rows], CONV)
    forest = chat.build(frame)
    convs = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    back = {}
    for r in sorted(chat.read_back(forest).collect(), key=lambda r: r.depth):
        back.setdefault(r.conv_id, []).append((r.role, r.text, r.loss))
    assert back == {c: [(a, b, b if a == "assistant" else None) for a, b in turns] for c, turns in convs.items()}
    nodes = {n.node: n for n in forest.nodes.collect()}
    assert len(nodes) == len({tuple(turns[: k + 1]) for turns in convs.values() for k in range(len(turns))})
    spans = sorted((n.dfs_start, n.dfs_end) for n in nodes.values())
    assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    inside = {n.node: n.dfs_end for n in nodes.values()}  # where each subtree ends
    for n in sorted(nodes.values(), key=lambda n: -n.depth):
        if n.parent:
            inside[n.parent] = max(inside[n.parent], inside[n.node])
    size = dict.fromkeys(nodes, 0)
    for n in sorted(nodes.values(), key=lambda n: -n.depth):
        size[n.node] += len(n.segment)
        if n.parent:
            size[n.parent] += size[n.node]
    starts = sorted((n.dfs_start, n.node) for n in nodes.values())
    assert all(inside[n.node] - n.dfs_start == size[n.node] and n.dfs_end - n.dfs_start == len(n.segment) for n in nodes.values())  # depth first: a subtree is one run
    for n in list(nodes.values())[:: max(1, len(nodes) // 400)]:
        up, way = n, []
        while up.parent:
            up = nodes[up.parent]
            way.append(up)
        assert n.depth == len(way) and n.pos_start == sum(len(x.segment) for x in way)
        held = [node for a in n.ancestors for node in (s[1] for s in starts[bisect.bisect_left(starts, (a.dfs_start, "")) : bisect.bisect_left(starts, (a.dfs_end, ""))])]
        assert sorted(held) == sorted(x.node for x in way) and sum(a.dfs_end - a.dfs_start for a in n.ancestors) == n.pos_start
    return nodes


def test_chat_round_trip_and_shared_turns(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|> \\<\\| <\\|x"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (3, 0, None, None), (4, 0, "a\nb%0A", "x"), (None, 0, "user", "hi"), (4, 0, "a\nb%0A", "x")]
    assert len(check_forest(spark, rows)) == 6  # hi, its two answers, the empty one, and two equal turns in a row
    empty = chat.build(spark.createDataFrame([], CONV))
    assert empty.nodes.count() == 0 and chat.digests(chat.read_back(empty)).count() == 0


def test_chat_trees_of_many_shapes(spark):
    rng = random.Random(6)
    rows = []
    for c in range(120):  # a system prompt shared by most, then few words, so many branches
        turns = [("system", "be brief")] if c % 9 else []
        turns += [(("user", "assistant")[k % 2], rng.choice("ab")) for k in range(rng.randint(0, 9))]
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(500 + c, k, "user", "same" if k < c else f"own {c}") for c in range(12) for k in range(13)]  # a branch at every turn
    check_forest(spark, rows)


def test_chat_of_one_very_long_conversation_grows_linearly(spark):
    """A conversation of 5,000 turns over several partitions, equal turns and a null id; what a row holds does not grow with its depth."""
    rows = [(None, k // 3, ("user", "assistant")[k % 2], f"t{k // 4}") for k in range(5000)] + [(1, 0, "user", "t0"), (1, 1, "assistant", "x" * 100_000)]
    nodes = check_forest(spark, rows)
    assert max(len(n.ancestors) for n in nodes.values()) <= 2
    got = {r.conv_id: r for r in chat.digests(chat.read_back(chat.build(spark.createDataFrame([(*r, "n") for r in rows], CONV)))).collect()}
    assert got[None].n_turns == 5000 and got[1].loss_chars == 100_000


def test_merkle_audit_finds_changed_missing_and_extra(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 7), "c") for i in range(300)] + [(None, None, None, None)]
    make = lambda r: spark.createDataFrame(r, "page_id long, url string, html string, size string")
    bad = [(i, u, h + "!" if i in (5, 250) else h, c) for i, u, h, c in rows if i is not None] + [(None, None, None, None)]
    got = {r.page_id: r for r in merkle.fixity(make(rows), make(bad), fanout=4).collect()}
    assert len(got) == 301 and {i for i, r in got.items() if r.state != "same"} == {5, 250}
    assert got[None].rec_no == 0 and got[0].start == got[None].size
    short = merkle.fixity(make(rows), make(rows[:150] + rows[300:]), fanout=4).groupBy("state").count().collect()
    assert {r.state: r["count"] for r in short} == {"same": 151, "missing": 150}
    assert merkle.fixity(make([]), make([]), fanout=4).count() == 0


def test_merkle_audit_locates_losses_and_extras_in_the_middle(spark):
    rows = [(2 * i, f"http://x/{i}", f"<p>{i}</p>" * (i % 7)) for i in range(300)] + [(None, None, None), (100, "u", "twin"), (100, "u", "twin"), (200, "u", "other")]
    make = lambda r: spark.createDataFrame(r, "page_id long, url string, html string")
    state = lambda a, b: sorted(((r.page_id, r.state) for r in merkle.fixity(make(a), make(b), fanout=4).collect() if r.state != "same"), key=repr)
    without = lambda i: [r for r in rows if r[0] != i]
    assert state(rows, without(302)) == [(302, "missing")] and state(without(302), rows) == [(302, "extra")]
    assert state(rows, [*rows, (301, "u", "new"), (-5, "u", "first"), (9999, "u", "last")]) == [(-5, "extra"), (301, "extra"), (9999, "extra")]
    changed = [(i, u, "!" if i == 88 else h) for i, u, h in without(44)] + [(45, "u", "new")]
    assert state(rows, changed) == [(44, "missing"), (45, "extra"), (88, "differs")]
    one_twin = [*rows]
    one_twin.remove((100, "u", "twin"))
    assert state(rows, one_twin) == [(100, "missing")] and state(one_twin, rows) == [(100, "extra")]
    assert state(rows, [r for r in rows if r[2] != "other"] + [(200, "u", "changed")]) == [(200, "differs")]
    assert state(rows, without(None)) == [(None, "missing")] and state([], rows[:9]) == [(2 * i, "extra") for i in sorted(range(9), key=lambda i: repr((2 * i, "extra")))]
    a = merkle.leaves(make(rows), "a", None, 4)
    b = merkle.leaves(make(without(302)), "b", merkle.starts(a, 4), 4)
    n = -(-a.count() // 4)
    assert merkle.audit(merkle.tree(a, n, 4), merkle.tree(b, n, 4), 4).count() == 1
    got = merkle.fixity(make(without(302)), make(rows), fanout=4).filter("state = 'extra'").first()
    assert got.rec_no == sum(i is None or i < 302 for i, _, _ in rows) and got.size > 0


def test_license_rules_need_their_order(docs):
    by = {i: s for s, i in licenses.SENTENCES.items()}
    bsd = [by[x] for x in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "bsd-asis")]
    texts = [". ".join(bsd) + ".", ". ".join(bsd[:3] + ["between us"] + bsd[4:]) + ".", ". ".join(bsd[::-1]) + ".", "Released under the MIT License.", None, "", "nothing; here."]
    got = [(r.rules, r.licenses) for r in licenses.scan(docs(texts)).orderBy("doc_id").collect()]
    assert got == [(["bsd3-text"], ["BSD-3-Clause"]), (["bsd2-text"], ["BSD-2-Clause"]), ([], []), (["mit-notice"], ["MIT"]), ([], []), ([], []), ([], [])]


MIT = [
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
]
ISC = ["Copyright (c) 2020 Some Body", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."]
BSD3 = [
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
]
APACHE = [
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "    http://www.apache.org/licenses/LICENSE-2.0",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
]
GPL = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
USEFUL = "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
MPL = ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."]
LGPL = [GPL.format(";", ";", 2.1).replace("program", "library").replace("GNU General", "GNU Lesser General"), USEFUL.replace("program", "library").replace("GNU General", "GNU Lesser General")]
AGPL = [GPL.format(":", ",", 3).replace("GNU General", "GNU Affero General"), USEFUL.replace("GNU General", "GNU Affero General")]
ZLIB = [
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
]
EPL = ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"]
WRAPPED = {"lgpl21-header": LGPL, "agpl3-header": AGPL, "zlib-text": ZLIB, "epl2-notice": EPL, "mit-text": MIT, "isc-text": ISC, "bsd3-text": BSD3, "bsd2-text": BSD3[:3] + BSD3[4:], "apache2-header": APACHE, "gpl3-header": [GPL.format(":", ",", 3), USEFUL], "gpl2-header": [GPL.format(";", ";", 2), USEFUL], "mpl2-notice": MPL}


@pytest.mark.parametrize("leader", ["", " * ", "# ", "// ", ";; ", "dnl "])
def test_wrapped_licences_are_found(docs, leader):
    wrap = lambda p: "\n".join(leader + x for x in textwrap.wrap(p, 72))
    texts = [f"\n{leader.rstrip()}\n".join(map(wrap, paragraphs)) for paragraphs in WRAPPED.values()]
    texts += [t.replace("\n", "\r\n") for t in texts]
    got = [r.rules for r in licenses.scan(docs(texts)).orderBy("doc_id").collect()]
    assert got == [[x] for x in WRAPPED] * 2
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})  # read by the SQL
    con = duckdb.connect()
    con.register("documents", documents)
    assert con.execute(f"SELECT rules FROM ({licenses.oracle()}) ORDER BY doc_id").fetchall() == [(x,) for x in [*WRAPPED] * 2]


def test_licences_on_odd_tables(docs):
    by = {i: s for s, i in licenses.SENTENCES.items()}
    long = "word " * 400_000 + "\n\n" + by["mit-ref"] + ".\n\n" + "more " * 100_000
    rows = [(1, long), (1, long), (None, by["gpl3-ref"]), (2, None), (3, by["mit-ref"] + ".\n" + by["mit-ref"])]
    got = sorted((r.doc_id or 0, r.n_license_sentences, r.licenses) for r in licenses.scan(docs(rows)).collect())
    assert got == [(0, 1, ["GPL-3.0-only"]), (1, 1, ["MIT"]), (1, 1, ["MIT"]), (2, 0, []), (3, 2, ["MIT"])]
    assert licenses.scan(docs([])).count() == 0


def test_each_known_sentence_is_found_alone(docs):
    got = [r.sentence_ids for r in licenses.scan(docs([s.capitalize() + "." for s in licenses.SENTENCES])).orderBy("doc_id").collect()]
    assert got == [[i] for i in licenses.SENTENCES.values()]


def test_known_sentences_need_whole_pieces_of_one_paragraph(docs):
    texts = ["This project is\nlicensed under the MIT License", "Licensed under the\n\nMIT License.", "It is not licensed under the MIT License.", "It is\nreleased under the MIT License\nLicensed under CC BY 4.0\n", "x. Licensed under the MIT\nLicense or not"]
    got = [(r.n_license_sentences, r.rules) for r in licenses.scan(docs(texts)).orderBy("doc_id").collect()]
    assert got == [(1, ["mit-notice"]), (0, []), (0, []), (2, ["mit-notice", "ccby4-notice"]), (0, [])]


def test_mixing_meets_its_weights(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 16_000, "big").when(F.col("id") < 19_000, "small").alias("source"), F.lit(1).alias("rate"), F.lit(9).alias("copy_no"), F.lit("w").alias("w"), F.lit("r").alias("row"), F.lit("k").alias("key"), F.lit(-1).alias("n"), F.lit("d").alias("a.b"))
    got = {r.source: r["count"] for r in mixing.mix(rows, {"big": 1.0, "small": 2.0, "": 1.0}).groupBy("source").count().collect()}
    assert abs(got["big"] - 5000) < 300 and abs(got["small"] - 10_000) < 400 and abs(got[None] - 5000) < 300
    assert "" not in got and mixing.mix(rows.limit(0)).count() == 0 and mixing.mix(rows).columns == ["doc_id", "text", "source", "rate", "w", "row", "key", "n", "a.b", "copy_no", "shuffle_key"]
    assert mixing.mix(rows).select("rate", "w", "row", "key", "n", "`a.b`").distinct().collect() == [(1, "w", "r", "k", -1, "d")]


@pytest.mark.parametrize("rate", [3.0, 690.0, 1000.0, 50_000.0])
def test_poisson_numbers_have_their_mean_and_variance(spark, rate):
    n = 2000 if rate < 10_000 else 300
    got = [r.n for r in spark.range(n).select(mixing.draws("s", F.col("id").cast("string"), F.lit(rate)).alias("n")).collect()]
    mean = sum(got) / n
    assert abs(mean - rate) < 5 * (rate / n) ** 0.5
    assert abs(sum((x - mean) ** 2 for x in got) / n / rate - 1) < 5 * (2 / n) ** 0.5 + 0.1


def test_mixing_of_a_small_source_with_a_large_share(spark):
    rows = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 2, "tiny").otherwise("big").alias("source"))
    got = {r.source: r["count"] for r in mixing.mix(rows, {"tiny": 1.0, "big": 1.0}).groupBy("source").count().collect()}
    assert abs(got["tiny"] - 2000) < 5 * 2000**0.5 and abs(got["big"] - 2000) < 5 * 2000**0.5


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    done = {}
    for name, stage in p.STAGES:
        before = docs
        docs = p.materialize(stage(spark, docs, SF), "test")
        done[name] = (before, docs)
    before, after = (x.select("doc_id", "text").collect() for x in done["exact dedup"])
    best = {}
    for r in before:
        best[low(r.text)] = max(r.doc_id, best.get(low(r.text), -1))
    assert sorted(r.doc_id for r in after) == sorted(best.values())
    before, after = (x.select("doc_id", "text").collect() for x in done["near dedup"])
    assert sorted(r.doc_id for r in after) == sorted(i for i, _, c in components_of([tuple(r) for r in before]) if i == c)
    before, after = done["mixing"]
    assert set(after.columns) == set(p.COLUMNS) and after.select("doc_id").subtract(before.select("doc_id")).count() == 0
    before, after = done["sentencepiece"]
    keys = after.select("doc_id", "copy_no").distinct()
    assert keys.count() == before.count() and keys.groupBy("doc_id").max("copy_no").agg({"max(copy_no)": "max"}).first()[0] > 1
    texts = {r.doc_id: r.text or "" for r in before.collect()}
    back = pieces.decode(after).select("doc_id", "text").collect()
    assert {r.doc_id for r in back} == set(texts) and all(r.text == texts[r.doc_id] for r in back)


def test_pipeline_stages_on_odd_tables(spark, tmp_path):
    """Empty tables, null and empty texts, null sources, repeated rows, labels without rows and extra columns."""
    import corpus_pipeline as p

    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kind = "doc_id long, text string, lang string, source string, n_chars long, kept string, rank int"
    long = "very long text " * 20_000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two three four five six", "en", "a", 5), (3, "one two three four five six", "en", "a", 5), (None, "null id here", "en", None, 3), (9, long, "en", "b", len(long))]
    for table in ([], rows):
        docs = spark.createDataFrame([(*r, "k", 1) for r in table], kind)
        for name, stage in p.STAGES:
            before = docs
            docs = p.materialize(stage(spark, docs, str(tmp_path)), "odd")
            if name != "sentencepiece":
                assert docs.columns == p.COLUMNS
            if name in ("quality classifier", "exact dedup"):
                assert docs.count() == {"quality classifier": len(table), "exact dedup": 4 if table else 0}[name]
        assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


BSD_HEAD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
BSD_TAIL = "THIS SOFTWARE IS PROVIDED BY {} \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL {} BE LIABLE FOR ANY DIRECT DAMAGES."
PROMOTE = "used to endorse or promote products derived from this software without specific prior written permission.\n\n"
FREE = "This {} is free software: you can redistribute it and/or modify it under the terms of the {} as published by the Free Software Foundation, {}.\n\nThis {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
LATER = "either version {} of the License, or (at your option) any later version"
APACHE_TEXT = "                                 Apache License\n                           Version 2.0, January 2004\n                        http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n   1. Definitions.\n\n      \"License\" shall mean the terms and conditions for use, reproduction,\n      and distribution as defined by Sections 1 through 9 of this document."
PUBLISHED = [  # texts as they are published or commonly written, with the licence that each one is
    (BSD_HEAD + "3. Neither the name of Example Inc. nor the names of its contributors may be " + PROMOTE + BSD_TAIL.format("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT OWNER"), ["BSD-3-Clause"]),
    (BSD_HEAD + "3. Neither the name of the University of California, Berkeley nor the names of its\n   contributors may be " + PROMOTE + BSD_TAIL.format("THE REGENTS AND CONTRIBUTORS", "THE REGENTS"), ["BSD-3-Clause"]),
    (BSD_HEAD + "3. The name of the author may not be " + PROMOTE + BSD_TAIL.format("THE AUTHOR", "THE AUTHOR"), ["BSD-3-Clause"]),
    (BSD_HEAD + BSD_TAIL.format("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", "THE COPYRIGHT HOLDER"), ["BSD-2-Clause"]),
    (BSD_HEAD + BSD_TAIL.format("EXAMPLE INC", "EXAMPLE INC"), ["BSD-2-Clause"]),
    (BSD_HEAD + "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software.\n\n4. Neither the name of the University nor the names of its contributors may be " + PROMOTE + BSD_TAIL.format("THE REGENTS AND CONTRIBUTORS", "THE REGENTS"), ["BSD-4-Clause"]),
    (FREE.format("program", "GNU General Public License", "version 3 of the License", "program"), ["GPL-3.0-only"]),
    (FREE.format("program", "GNU General Public License", "version 3", "program"), ["GPL-3.0-only"]),
    (FREE.format("program", "GNU General Public License", LATER.format(2), "program").split("\n\n")[0], ["GPL-2.0-or-later"]),
    (FREE.format("program", "GNU General Public License", LATER.format(3), "program"), ["GPL-3.0-or-later"]),
    (FREE.format("library", "GNU Lesser General Public License", LATER.format("2.1"), "library"), ["LGPL-2.1-or-later"]),
    (FREE.format("library", "GNU Lesser General Public License", LATER.format(3), "library"), ["LGPL-3.0-or-later"]),
    (FREE.format("program", "GNU Affero General Public License", LATER.format(3), "program"), ["AGPL-3.0-or-later"]),
    (FREE.format("software", "GNU Affero General Public License", "version 3 of the License", "software"), ["AGPL-3.0-only"]),
    (APACHE_TEXT, ["Apache-2.0"]),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.\n", ["GPL-3.0-only"]),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n", ["MPL-2.0"]),
    ("// SPDX-License-Identifier: Apache-2.0\nint main;", ["Apache-2.0"]), ("/* SPDX-License-Identifier: GPL-2.0+ */", ["GPL-2.0-or-later"]), ("# SPDX-License-Identifier: GPL-2.0\n", ["GPL-2.0-only"]), ("SPDX-License-Identifier: BSD-3-Clause", ["BSD-3-Clause"]), ("SPDX-License-Identifier: MPL-1.1\n", ["MPL-1.1"]),
    ("This project is licensed under the terms of the MIT license.", ["MIT"]), ("Distributed under the terms of the GNU GPL v2.", ["GPL-2.0-only"]), ("This file is distributed under the terms of the GNU General Public License version 3 or later.", ["GPL-3.0-or-later"]),
    ("Released under the Apache License 2.0.\n", ["Apache-2.0"]), ("Licensed under an MIT license.", ["MIT"]), ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA-4.0"]), ("Available under the Boost Software License, Version 1.0.", ["BSL-1.0"]), ("Licensed under the EUPL 1.2.", ["EUPL-1.2"]),
    ("It is said to be licensed under the MIT license.", []), ("SPDX-License-Identifier: NoSuch-1.0", []), ("Neither the name of the rose nor the names of its friends matter.", []), ("The GNU General Public License version 3 is long.", []), ("Licensed under the moon.", []),
]


@pytest.mark.parametrize("leader", ["", " * ", "# "])
def test_published_texts(docs, leader):
    """Whole texts with a known answer, plain and in comments; the SQL gives the same."""
    texts = ["\n".join((leader + x).rstrip() for x in t.split("\n")) for t, _ in PUBLISHED]
    got = [r.licenses for r in licenses.scan(docs(texts)).orderBy("doc_id").collect()]
    assert [(t, g) for (t, _), g in zip(PUBLISHED, got)] == PUBLISHED
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    assert con.execute(f"SELECT licenses FROM ({licenses.oracle()}) ORDER BY doc_id").fetchall() == [(",".join(x),) for _, x in PUBLISHED]


def test_warc_files_have_records_at_the_audited_offsets(spark, tmp_path):
    """The bytes of the files, one after the other, at each offset of the audit; repeated ids, equal rows, nulls and long pages among them."""
    import hashlib

    rows = [(i % 40 if i % 7 else None, f"http://x/{i % 9}" if i % 5 else None, f"<p>é {i % 31}</p>\r\n\n" * (i % 4) if i % 11 else None) for i in range(300)] + [(3, "u", "z" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    merkle.write_warc(pages, f"{tmp_path}/w")
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    got = merkle.fixity(pages, pages).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == len(data)
    assert all(hashlib.sha256(data[r.start : r.start + r.size]).hexdigest() == r.digest for r in got) and [r.start for r in sorted(got, key=lambda r: r.rec_no)] == sorted(r.start for r in got)
    merkle.write_warc(pages.limit(0), f"{tmp_path}/none")
