import random
import re

import numpy as np
import pytest
import xxhash

from foliant.llm import kernel, queries, simhash

from .test_exact_and_near import low

SF = "/root/testdata/sf0.001"


def fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42) for i in range(max(1, len(words) - size + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def parts(fps):
    """The least index of each one's component, by comparing all pairs."""
    fps = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 2
    while True:
        new = np.array([label[near[i]].min() for i in range(len(fps))])
        if (new == label).all():
            return label.tolist()
        label = new


def check(docs, rows, **how):
    got = {r.doc_id: r for r in simhash.resolve(docs(rows), **how).collect()}
    fps = [fingerprint(t) for _, t in rows]
    label = parts(fps)
    assert len(got) == len(rows)
    for k, (i, _) in enumerate(rows):
        assert got[i].fingerprint == f"{fps[k]:016x}" and got[i].component_id == min(rows[j][0] for j in range(len(rows)) if label[j] == label[k])


def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefÉgh") for _ in range(rng.randint(1, 7)))
    base = [" ".join(word() for _ in range(rng.choice([1, 2, 3, 5, 40, 400]))) for _ in range(60)]
    out = [*base, "", None, " \t\n", "a", "A", "a  b", "a\tb", "x " * 4000, "w" * 100_000, "a b c a b c"]
    for b in base:
        for _ in range(4):
            words = b.split()
            words[rng.randrange(len(words))] = word()
            out.append(" ".join(words) + (" end" if rng.random() < 0.3 else ""))
    return list(enumerate(out))


@pytest.mark.parametrize("most", [512, 1])
def test_against_all_pairs(docs, most):
    check(docs, texts(), most=most)


def crowd(rng, n):
    """Fingerprints that walk from a few bases by one to three bits, so that lists are long and components chains."""
    out = [rng.getrandbits(64) for _ in range(3)]
    while len(out) < n:
        x = rng.choice(out[-40:])
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64 if rng.random() < 0.5 else 12)
        out.append(x)
    return sorted({*out, *(rng.getrandbits(64) for _ in range(n // 3)), 0, 1, 2**64 - 1})


@pytest.mark.parametrize("most", [600, 20, 2, 1])
def test_links_of_crowded_lists_against_all_pairs(spark, most):
    fps = crowd(random.Random(most), 500)
    frame = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in fps], "fp long")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(frame, len(fps), most).collect()]
    assert all((a ^ b).bit_count() <= 16 for a, b in found)
    root = {x: x for x in fps}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in found:
        root[max(top(a), top(b))] = min(top(a), top(b))
    label = parts(fps)
    assert [top(x) for x in fps] == [fps[k] for k in label]
    assert len(found) <= 28 * len(fps)  # a link for each member of a list, not for each pair


def test_full_list_of_two_bytes():
    fp = np.arange(1 << 16, dtype=np.uint64) << np.uint64(24)
    assert len(simhash.neighbours(fp)) == (1 << 16) - 1 and simhash.neighbours(fp[[0, 7]]) == [] and simhash.neighbours(fp[[0, 3]]) == [(0, 1)]


def test_bits_of_many_shingles():
    rng = random.Random(9)
    text = " ".join(f"w{rng.randrange(400)}" for _ in range(3000))
    import pyarrow as pa

    (chunk,) = kernel.chunks(pa.array([text, None, "one two", text + " more"]))
    n, fp = simhash.fingerprints(chunk)
    assert n.tolist() == [2998, 0, 1, 2999] and fp.tolist() == [fingerprint(t) for t in (text, None, "one two", text + " more")]


def test_repeated_null_and_no_rows(docs):
    got = simhash.resolve(docs([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, None), (9, "")])).collect()
    assert len(got) == 5 and {r.component_id for r in got} == {5, 9}
    assert {r.component_id for r in simhash.resolve(docs([(None, "p q")])).collect()} == {None} and simhash.resolve(docs([])).count() == 0


def test_query_against_all_pairs(spark):
    d = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").collect()]
    label = parts([fingerprint(t) for _, t in d])
    least = {}
    for k, (i, _) in enumerate(d):
        least[label[k]] = min(least.get(label[k], i), i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op11_simhash_bytes(spark, SF).collect()}
    assert got == {i: (f"{fingerprint(t):016x}", least[label[k]]) for k, (i, t) in enumerate(d)}
