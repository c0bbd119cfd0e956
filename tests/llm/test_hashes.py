"""Texts whose polynomial hashes modulo a power of two are equal at every odd point must still be told apart."""

import numpy as np
import pytest

from foliant.llm import chat, kernel, near_dedup, pieces, repetition

from .test_models import check_scores
from .test_texts import CONV, check_forest

ORDER = [bin(i).count("1") % 2 for i in range(4096)]


def pair(a="a", b="b", n=1024):
    """The Thue-Morse sequence and its complement."""
    return [[(a, b)[x ^ y] for x in ORDER[:n]] for y in (0, 1)]


one, two = ("".join(x) for x in pair())


def test_spans_of_every_length_are_told_apart():
    rng = np.random.default_rng(2)
    spans = [rng.integers(97, 99, n, dtype=np.uint8).tobytes() for n in range(40) for _ in range(20)] + [b"\0" * n for n in range(1, 20)] + [one.encode(), two.encode()]
    raw, ends = np.frombuffer(b"".join(spans), np.uint8), np.cumsum([len(s) for s in spans])
    h = kernel.spans_hash(raw, ends - [len(s) for s in spans], ends)
    assert len(set(h.tolist())) == len(set(spans)) == len({(s, int(x)) for s, x in zip(spans, h)})
    assert set(h.tolist()) & set(kernel.spans_hash(raw, ends - [len(s) for s in spans], ends, 1).tolist()) == {0}  # the empty span's


def test_samples_decode_to_their_own_text(docs):
    texts = [f"{one} {two}", two, one, f"{one}\n{one}"]
    got = pieces.decode(pieces.sample(docs(texts), k=2)).toPandas()
    assert all(r.text == texts[r.doc_id] for r in got.itertuples()) and set(got["doc_id"]) == {0, 1, 2, 3}


def test_units_of_equal_hashes_do_not_share_a_lattice(docs, monkeypatch):
    """All first hashes equal by force: bytes are compared, and units hashed anew until they differ."""
    real = kernel.spans_hash
    monkeypatch.setattr(kernel, "spans_hash", lambda raw, s, e, seed=0: real(raw, s, e, seed) if seed else np.zeros(len(s), np.uint64))
    v = pieces.Vocabulary(open(pieces.MODEL, "rb").read())
    raw = np.frombuffer(b"alpha beta alpha gamma alphabet", np.uint8)
    starts = np.array([0, 6, 11, 17, 23])
    ends = np.array([5, 10, 16, 22, 31])
    node = pieces.shared_nodes(raw, starts, ends, v)
    held = v.lattices.raw
    assert [held[n : n + e - s].tobytes() for n, s, e in zip(node, starts, ends)] == [raw[s:e].tobytes() for s, e in zip(starts, ends)]


def test_near_dedup_does_not_link_them(docs):
    got = near_dedup.resolve(docs([one, two, f"{one} x y z", f"{two} x y z"]), 3, 85).toPandas()
    assert (got["component_id"] == got["doc_id"]).all() and got["kept"].all()


def test_lines_and_words_are_not_repeats(docs):
    got = {r.doc_id: r for r in repetition.judge(docs([f"{one}\n{two}", f"{one}\n{one}"])).collect()}
    assert got[0].n_dup_lines == 0 and got[1].n_dup_lines == 1


@pytest.mark.parametrize("n", [1024, 4096])
def test_conversations_are_not_merged(spark, n):
    rows = [(c, k, *t) for c, turns in enumerate(pair(("user", "a"), ("user", "b"), n)) for k, t in enumerate(turns + [("assistant", "end")])]
    check_forest(spark, rows)


def test_prime_field():
    rng = np.random.default_rng(1)
    edge = [0, 1, 2**31 - 1, 2**31, chat.PRIME - 1]
    a, b = (np.array([*edge, *rng.integers(0, chat.PRIME, 500).tolist(), *edge[::-1]], np.uint64) for _ in range(2))
    exact = lambda f: [f(int(x), int(y)) % chat.PRIME for x, y in zip(a, b)]
    assert chat.times(a, b).tolist() == exact(lambda x, y: x * y) and chat.minus(a, b).tolist() == exact(lambda x, y: x - y)
    assert chat.sums(a).tolist() == [sum(map(int, a[:k])) % chat.PRIME for k in range(len(a) + 1)]
    assert chat.power(chat.BASES[0], np.arange(30)).tolist() == [pow(chat.BASES[0], k, chat.PRIME) for k in range(30)]


def test_model_counts_them_apart(spark, docs):
    rows = [(i, f"{one} {one} x") for i in range(20)] + [(50 + i, f"{two} x" if i % 2 else "y") for i in range(20)]
    check_scores(spark, docs(rows), rows)
