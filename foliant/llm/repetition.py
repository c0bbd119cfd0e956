"""Quality rules on repetition, from a suffix array of each text's words.

The suffixes of all texts of a chunk are sorted together by prefix doubling; words of different
texts get different symbols, so no match crosses texts. Suffixes that are alone leave the sort, so
each round costs only what is still repeated. From the order and the common-prefix lengths of
neighbours come the LCP intervals; those whose occurrences differ in the word before (or begin a text) are the maximal repeated
substrings of at least `least` words. Their spans' union is limited to a share of the words, and
the longest to a number of words.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; rows with
equal ids, or equal altogether, are judged one by one; a very long text is whole, held by one task; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import kernel as K

WINDOW = 8
LEAST = 5
MOST_SHARE = 0.25
MOST_LONGEST = 100
MIN_WORDS = 20
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "n_maximal_repeats long, covered_words long, longest_repeat long, spans array<struct<from_word:int,to_word:int>>"
)


def suffix_ranks(symbol: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in suffix order, and for each power of two 2**j each position's class by its first 2**j symbols.

    A class is the place of its first member in the order, so classes sort as their suffixes do; a
    suffix that is alone keeps its class. end: where the text of each position ends.
    """
    n = len(symbol)
    rank, at, width, levels = np.zeros(n, np.int64), np.arange(n), 0, []
    while len(at):
        second = symbol[at] if not width else np.where(at + width < end[at], rank[np.minimum(at + width, n - 1)] + 1, 0)
        key = rank[at] * np.int64(n + 2) + second
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        place = np.arange(len(at))
        new = np.concatenate([[True], key[1:] != key[:-1]])
        old = rank[at]
        began = np.concatenate([[True], old[1:] != old[:-1]])
        rank = rank.copy()
        rank[at] = old + np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(began, place, 0))
        levels.append(rank)
        alone = new & np.concatenate([new[1:], [True]])
        at, width = at[~alone], max(1, 2 * width)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray], least: int) -> np.ndarray:
    """For each suffix in order, the symbols it shares with the one before; 0 where fewer than `least`."""
    n, lcp = len(order), np.zeros(len(order), np.int64)
    base = least.bit_length() - 1
    if base >= len(levels) or n < 2:
        return lcp
    near = np.nonzero(levels[base][order[1:]] == levels[base][order[:-1]])[0] + 1
    a, b, length = order[near - 1], order[near], np.zeros(len(near), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        x, y = a + length, b + length
        inside = np.maximum(x, y) < n
        same = levels[j][np.minimum(x, n - 1)] == levels[j][np.minimum(y, n - 1)]
        length += np.where(inside & same, 1 << j, 0)
    lcp[near] = np.where(length >= least, length, 0)
    return lcp


def maximal_repeats(order: np.ndarray, lcp: np.ndarray, before: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """How many LCP intervals of each text are maximal: the words before their occurrences differ, or one begins the text (-1)."""
    found = np.zeros(n_docs, np.int64)
    places = np.nonzero(lcp)[0]
    stack: list[list[int]] = []  # [length, word before, -2 where they differ, text]
    last = -2

    def close(down_to: int) -> None:
        while stack and stack[-1][0] > down_to:
            length, left, text = stack.pop()
            if left < 0:
                found[text] += 1
            if stack and stack[-1][0] >= down_to:
                stack[-1][1] = left if stack[-1][1] == left else -2
            elif down_to:
                stack.append([down_to, left, text])

    for p, length, one, two, text in zip(places.tolist(), lcp[places].tolist(), before[order[places - 1]].tolist(), before[order[places]].tolist(), doc[order[places]].tolist()):
        if p != last + 1:
            close(0)
        else:
            close(length)
        if not stack or stack[-1][0] < length:
            stack.append([length, one, text])
        top = stack[-1]
        top[1] = top[1] if top[1] == two and two >= 0 else -2
        last = p
    close(0)
    return found


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def duplicate_lines(chunk: K.Chunk) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    breaks = np.nonzero(chunk.raw == 0x0A)[0]
    per = np.diff(np.searchsorted(breaks, chunk.offsets)) + 1
    starts = np.sort(np.concatenate([chunk.offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, chunk.offsets[1:]]), kind="stable")
    doc = np.repeat(np.arange(chunk.n), per)
    solid = np.concatenate([[0], np.cumsum(~K.SEP[chunk.raw])])
    has = solid[ends] > solid[starts]
    h, doc = K.spans_hash(chunk.raw, starts[has], ends[has]), doc[has]
    order = np.lexsort((h, doc))
    again = (h[order][1:] == h[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][1:][again], minlength=chunk.n)


def measure(chunk: K.Chunk, least: int = LEAST, window: int = WINDOW, most_share: float = MOST_SHARE, most_longest: int = MOST_LONGEST) -> list[pa.Array]:
    w, n_docs = K.words(chunk, False), chunk.n
    n = len(w.hashes)
    by_text = lambda values: np.bincount(w.doc, values, minlength=n_docs).astype(np.int64) if n else np.zeros(n_docs, np.int64)
    head = np.concatenate([[0], np.cumsum((chunk.raw & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(SYMBOL[chunk.raw])])
    n_symbols = symbols[chunk.offsets[1:]] - symbols[chunk.offsets[:-1]]
    first = np.concatenate([[0], np.cumsum(w.counts)])
    symbol = np.unique(K.mix(w.hashes + w.doc.astype(K.U) * K.U(0x9E3779B97F4A7C15)), return_inverse=True)[1].astype(np.int64)
    end = np.repeat(first[1:], w.counts)
    order, levels = suffix_ranks(symbol, end)
    low = min(least, window)
    lcp = common_prefixes(order, levels, low)
    longest = np.zeros(n, np.int64)  # longest repeat that begins at each word
    longest[order] = np.maximum(lcp, np.concatenate([lcp[1:], [0]])) if n else 0
    starts = np.nonzero(longest >= window)[0]
    repeat = covered(starts, starts + window, n)
    starts = np.nonzero(longest >= least)[0]
    inside = covered(starts, starts + longest[starts], n)
    before = np.concatenate([[-1], symbol[:-1]]) if n else symbol
    before[first[:-1][w.counts > 0]] = -1
    repeats = maximal_repeats(order, np.where(lcp >= least, lcp, 0), before, w.doc, n_docs)
    top = np.zeros(n_docs, np.int64)
    np.maximum.at(top, w.doc, np.where(longest >= least, longest, 0))
    n_repeat, n_cover = by_text(repeat), by_text(inside)
    opens = np.nonzero(inside & ~(np.concatenate([[False], inside[:-1]]) & (before >= 0)))[0]
    stops = np.nonzero(inside & ~np.concatenate([inside[1:] & (w.doc[1:] == w.doc[:-1]), [False]]))[0] if n else opens
    spans = pa.StructArray.from_arrays([pa.array((opens - first[w.doc[opens]]).astype(np.int32)), pa.array((stops + 1 - first[w.doc[stops]]).astype(np.int32))], ["from_word", "to_word"])
    base_failed = (w.counts < MIN_WORDS) | (100 * n_repeat > 30 * w.counts)
    kept = ~base_failed & (n_cover <= most_share * w.counts) & (top <= most_longest)
    counts = [w.counts, by_text(head[w.ends] - head[w.starts]), n_symbols, duplicate_lines(chunk), n_repeat]
    offsets = np.searchsorted(opens, first)
    return [*(pa.array(x.astype(np.int64)) for x in counts), pa.array(base_failed), pa.array(kept), *(pa.array(x) for x in (repeats, n_cover, top)), K.list_array(spans, offsets)]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """doc_id and the measures of SCHEMA for each row of docs; no shuffle."""
    kind = dict(docs.dtypes)[id_col]
    names = [part.strip().split(" ")[0] for part in SCHEMA.split("array<")[0].split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in K.chunks(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.first, c.n), *measure(c, **limits)], ["doc_id", *names])
        K.release()

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
