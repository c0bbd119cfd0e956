"""Vectorised words, hashes and lines of a column of texts (numpy over Arrow buffers).

Everything works on UTF-8 bytes. A chunk is a run of whole texts of about CHUNK bytes, so
memory stays bounded however many rows a batch has; a single longer text is a chunk by itself.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
U = np.uint64
SEP = np.zeros(256, bool)
SEP[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KIND = np.where(SEP, 0, 2).astype(np.uint8)
KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 1


def release() -> None:
    """Gives freed memory back to the system at the end of a task: Spark keeps its Python workers, idle or not, beside later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal in, equal out, and all bits well spread."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


@dataclass
class Chunk:
    """Texts first..first+n of a batch: their bytes, and where each begins and ends."""

    first: int
    raw: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    counts: np.ndarray  # words of each text
    doc: np.ndarray  # text of each word


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield Chunk(at, data[ends[at] : ends[to]], ends[at : to + 1] - ends[at])
        at = to


def spans_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte span: the sum of its blocks of 8 bytes, each mixed with its place.

    The mixing is not linear, so no two byte strings have equal sums by their structure, as they may have where blocks are weighed by powers.
    """
    size = ends - starts
    n = (size + 7) >> 3
    first = np.cumsum(n) - n
    total = int(n.sum())
    place = np.arange(total) - np.repeat(first, n)
    at = np.repeat(starts, n) + 8 * place
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    block = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))[at]  # the 8 bytes from each place on
    left = np.minimum(np.repeat(ends, n) - at, 8).astype(U)
    block &= U(2**64 - 1) >> (U(64) - (left << U(3)))
    block += place.astype(U) * U(0x9E3779B97F4A7C15) + U((seed + 1) * 0xD1B54A32D192ED03 % 2**64)
    sums = np.zeros(len(starts), U)
    if total:
        sums[n > 0] = np.add.reduceat(mix(block), first[n > 0])
    return mix(sums + size.astype(U) * U(0x9FB21C651E98DF25))


def words(chunk: Chunk, lower: bool) -> Words:
    """Runs of bytes other than space and \\t-\\r; a text's end ends a word."""
    raw = LOWER[chunk.raw] if lower else chunk.raw
    inside = np.concatenate([[False], ~SEP[raw], [False]])
    edge = np.zeros(len(raw) + 1, bool)
    edge[chunk.offsets] = True
    starts = np.nonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))[0]
    ends = np.nonzero(inside[1:-1] & (~inside[2:] | edge[1:]))[0] + 1
    counts = np.diff(np.searchsorted(starts, chunk.offsets))
    return Words(starts, ends, spans_hash(raw, starts, ends), counts, np.repeat(np.arange(chunk.n), counts))


def tokens(chunk: Chunk) -> Words:
    """Runs of ASCII punctuation and runs of other bytes that are not blank, A-Z lower-cased."""
    raw = LOWER[chunk.raw]
    kind = np.concatenate([[0], KIND[raw], [0]])
    cut = kind[1:] != kind[:-1]
    cut[chunk.offsets] = True
    starts = np.nonzero((kind[1:-1] > 0) & cut[:-1])[0]
    ends = np.nonzero((kind[1:-1] > 0) & cut[1:])[0] + 1
    counts = np.diff(np.searchsorted(starts, chunk.offsets))
    return Words(starts, ends, spans_hash(raw, starts, ends), counts, np.repeat(np.arange(chunk.n), counts))


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each shingle, distinct within its text and sorted; with fewer words, the whole sequence is one."""
    n, k = len(w.hashes), size
    first = np.concatenate([[0], np.cumsum(w.counts)])
    short = np.nonzero((w.counts > 0) & (w.counts < k))[0]
    h = np.zeros(max(0, n - k + 1), U)
    for j in range(k):
        h = mix(h * U(0x100000001B3) + w.hashes[j : n - k + 1 + j]) if len(h) else h
    inside = w.doc[: len(h)] == w.doc[k - 1 :] if len(h) else np.zeros(0, bool)
    docs, found = w.doc[: len(h)][inside], h[inside]
    if len(short):
        more = []
        for d in short:
            x = np.full(1, 0xABCD + w.counts[d], U)
            for j in range(first[d], first[d + 1]):
                x = mix(x * U(0x100000001B3) + w.hashes[j])
            more.append(x[0])
        docs, found = np.concatenate([docs, short]), np.concatenate([found, np.array(more, U)])
    order = np.lexsort((found, docs))
    docs, found = docs[order], found[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (docs[1:] != docs[:-1])
    return docs[new], found[new]


def list_array(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
