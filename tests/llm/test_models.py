import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from foliant.llm import importance, kneser_ney
from foliant.llm import kernel as K
from foliant.llm.queries import table


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


def brute(rows):
    """base score and Kneser-Ney score of each text, from dictionaries."""
    train = [t for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 10]
    uni, bi = Counter(), Counter()
    for t in train:
        w = [*words(t), None]
        uni.update(w)
        bi.update(zip(["<s>", *w], w))
    n, v = sum(uni.values()), len(uni)
    below, of = Counter(w for _, w in bi), defaultdict(Counter)
    total = Counter()
    for (a, _), c in bi.items():
        total[a] += c
        of[a][min(c, 3)] += 1

    def disc(counts):
        k = [sum(c == j for c in counts) for j in (1, 2, 3, 4)]
        if not all(k):
            return [0, 0.5, 0.75, 0.9]
        y = k[0] / (k[0] + 2 * k[1])
        return [0, *(min(max(j - (j + 1) * y * k[j] / k[j - 1], 0), j) for j in (1, 2, 3))]

    d, e = disc(bi.values()), disc(below.values())
    types, back = len(bi), sum(e[min(c, 3)] for c in below.values()) / max(len(bi), 1)
    out = []
    for i, t in rows:
        w = [*words(t), None]
        base = sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = 0.0
        for a, x in zip(["<s>", *w], w):
            p = (below[x] - e[min(below[x], 3)]) / types + back / (v + 1)
            if total[a]:
                p = (bi[a, x] - d[min(bi[a, x], 3)]) / total[a] + sum(d[j] * of[a][j] for j in (1, 2, 3)) / total[a] * p
            score += math.log10(p)
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, score))
    return out


def check_scores(spark, docs, rows):
    got = kneser_ney.train_and_score(docs).collect()
    want = brute(rows)
    mine = sorted(zip([str(i) for i, _ in rows], want))
    theirs = sorted((str(r.doc_id), (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in got)
    for (i, a), (j, b) in zip(mine, theirs, strict=True):
        assert i == j and a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9)


def test_kneser_ney_against_dictionaries(spark, docs, monkeypatch):
    monkeypatch.setattr(kneser_ney, "PER_FILE", 40)
    monkeypatch.setattr(kneser_ney, "PENDING", 300)
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices([f"w{k}" for k in range(150)], [1 / (k + 1) for k in range(150)], k=rng.randint(0, 40)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "W1 w1 W1"), (503, "unseen words only"), (None, "w1 w2"), (504, "w3 " * 9000)]
    rows += [(600 + i, f"hot w{i % 90} hot W{i % 7}") for i in range(400)]  # a first word, and the begin mark, of far more than PENDING tokens
    check_scores(spark, docs(rows).repartition(5), rows)
    model = kneser_ney.train(docs(rows))
    hot = kneser_ney.opened(model).whole("hot")[0].tolist()
    assert len(hot) >= 2 and model.size in hot and hot == sorted(hot)


def test_lookups_visit_only_the_ranges_they_hit(tmp_path, monkeypatch):
    """20,000 ranges of five bigrams each: a query opens the files of its own ranges, few stay mapped, and what goes with a task is small."""
    import pickle
    import time

    monkeypatch.setattr(kneser_ney, "MAPS", 64)
    n, size = 20_000, 99_999
    cuts = np.arange(n + 1, dtype=np.int64) * 5 * (size + 1)
    for name, values in (("cuts", cuts), ("starts", np.array([0, size])), ("full", np.ones(n, bool)), ("hot", np.array([[7], [40], [1], [2], [3]]))):
        np.save(tmp_path / f"{name}.npy", values)
    model = kneser_ney.Model(str(tmp_path), 0, size, 10, (0.5, 0.75, 0.9), (0.5, 0.75, 0.9), 1, 1.0)
    rng = np.random.default_rng(1)
    hit = np.unique(rng.integers(0, n, 200))
    for k in hit:
        words = np.arange(5 * k, 5 * k + 5)
        np.save(tmp_path / f"pair-{k}.npy", words * (size + 1) + words)
        np.save(tmp_path / f"times-{k}.npy", words % 7 + 1)
        np.save(tmp_path / f"first-{k}.npy", np.tile(words % 7 + 1, (4, 1)))
    files, first = kneser_ney.Files(model), np.sort(np.concatenate([5 * hit, 5 * hit + 3]))
    files.pairs(first, first)
    began = time.perf_counter()
    counts, sums = files.pairs(first, first)
    assert time.perf_counter() - began < 2 and len(files.maps) <= 64 and len(pickle.dumps(model)) < 1000
    assert (counts == first % 7 + 1).all() and (sums[0] == np.where(first == 7, 40, first % 7 + 1)).all() and (files.pairs(first, first + 1)[0] == 0).all()


def test_kneser_ney_on_the_documents(spark):
    d = table(spark, "/root/testdata/sf0.001", "documents")
    check_scores(spark, d, [(r["doc_id"], r["text"]) for r in d.collect()])


def test_kneser_ney_sums_to_one(spark, docs):
    model = kneser_ney.train(docs(["a b a c", "b a", "c c a b"]))
    files = kneser_ney.opened(model)
    for start in ("", "a ", "b ", "zz "):
        p = {}
        _, _, before = kneser_ney.tokens(next(K.chunks(pa.array([f"{start}a"]))), files)
        prev = int(before[-2])
        for w in [*range(model.size), -1]:
            first, second = np.array([prev]), np.array([w])
            below = files.by_word("below", second) if w >= 0 else np.array([0])
            q = max(float(below[0] - kneser_ney.discount(below, model.below)[0]), 0) / model.types + model.back / (model.size + 1)
            if prev >= 0:
                c, s = files.pairs(first, second if w >= 0 else np.array([model.size]))
                c = c if w >= 0 else np.array([0])
                q = max(float(c[0] - kneser_ney.discount(c, model.discounts)[0]), 0) / s[0][0] + float(np.array(model.discounts) @ s[1:, 0]) / s[0][0] * q
            p[w] = q
        assert sum(p.values()) == pytest.approx(1)


def test_held_out_text_is_better_than_the_base(spark):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = kneser_ney.train_and_score(d).filter("held_out").toPandas()
    assert got["score"].sum() > got["base_score"].sum()


def test_kneser_ney_without_training_rows(spark, docs):
    got = kneser_ney.train_and_score(docs([(None, "a b")])).collect()
    assert [(r["n_tokens"], r["score"], r["train_tokens"]) for r in got] == [(3, 0.0, 0)]
    assert kneser_ney.train_and_score(docs([])).count() == 0


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def test_importance_weights_against_counters(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["good", "fine", "well"] if i % 3 else ["bad", "!!", "junk"]) for _ in range(rng.randint(1, 30)))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, "Good, FINE")]
    marks = [(i, int(i % 3 > 0), 0, None) for i in range(0, 60)] + [(None, 1, 0, None), (3, None, None, None)]
    target, raw, fine = importance.models(docs(rows), labels(spark, marks), buckets=1 << 14)
    b = 1 << 14

    def grams(t):
        return Counter(importance.features(next(K.chunks(pa.array([t or ""]))), b)[1].tolist())

    tokens = re.findall(r"[!,]+|[^\s!,]+", low("Good, FINE"))
    assert sum(grams("Good, FINE").values()) == 2 * len(tokens) - 1
    want_raw, want_target = Counter(), Counter()
    good = {i for i, q, *_ in marks if i is not None and q == 1} - {i for i, q, *_ in marks if not q}
    for i, t in rows:
        want_raw += grams(t)
        want_target += grams(t) if i in good else Counter()
    assert {k: int(x) for k, x in enumerate(raw) if x} == dict(want_raw)
    assert {k: int(x) for k, x in enumerate(target) if x} == dict(want_target)
    got = importance.log_weights(docs(rows), target, raw).toPandas().set_index("doc_id")
    assert {r.doc_id for r in fine.collect()} == good
    ratio = sum(want_target.values()) / sum(want_raw.values())

    def weight(k):
        t, e = want_target[k], want_raw[k] * ratio
        return math.log(t + 3) - math.log(e + 3) if abs(t - e) >= 3 * math.sqrt(e + 1) else 0.0

    assert any(weight(k) for k in want_raw)
    for i, t in rows:
        w = sum(n * weight(k) for k, n in grams(t).items())
        assert got.loc[i, "log_weight"] == pytest.approx(w, abs=1e-9)


@pytest.mark.parametrize("k", [1, 2, 17, 60, 99])
def test_kth_largest(spark, k):
    rng = random.Random(k)
    values = [rng.gauss(0, 50) for _ in range(60)] + [1.5] * 20 + [-0.25] * 20
    frame = spark.createDataFrame([(x,) for x in values], "key double")
    assert importance.kth_largest(frame, k) == sorted(values, reverse=True)[k - 1]


def test_gumbel_noise_samples_in_proportion(spark, docs):
    flat = importance.log_weights(docs([(i, "x") for i in range(4000)]), np.zeros(16), np.ones(16)).toPandas()
    noise = flat["key"] - flat["log_weight"]
    assert abs(noise.mean() - 0.5772) < 0.08 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.08


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    d, marks = table(spark, sf, "documents"), table(spark, sf, "labels")
    train, held = marks.filter("doc_id % 2 = 0"), marks.filter("doc_id % 2 = 1").toPandas().set_index("doc_id")
    got = importance.classify(d, train).toPandas().drop_duplicates("doc_id").set_index("doc_id").loc[held.index]
    clean = (held["quality"] == 1) & (held["toxic"] == 0)
    toxic = (held["quality"] == 1) & (held["toxic"] == 1)
    assert got.loc[clean, "kept"].mean() > 0.95 and got.loc[held["quality"] == 0, "kept"].mean() < 0.1 and got.loc[toxic, "kept"].mean() < 0.6


def test_classifier_cases(spark, docs):
    some = docs(["a b", None, ""])
    assert importance.classify(some, labels(spark, [])).filter("kept").count() == 3
    assert importance.classify(docs([]), labels(spark, [(1, 1, 0, None)])).count() == 0
    kept = importance.select(some, labels(spark, [(0, 1, 0, None), (1, 0, 0, None), (2, 0, 1, None)]))
    assert kept.columns == some.columns and 1 <= kept.count() <= 3
    marks = labels(spark, [(0, 1, 0, None)])
    twins = docs([(5, "a b"), (5, "a b"), (6, "c"), (7, "long text " * 30_000)])
    got = importance.classify(twins, marks, keep=0.5).toPandas()
    assert got.loc[got["doc_id"] == 5, "kept"].nunique() == 1 and got["kept"].sum() in (2, 3)  # rows that tie stay or go together
    assert [importance.classify(twins, marks, keep=x).filter("kept").count() for x in (0.0, 1.0)] == [0, 4]
