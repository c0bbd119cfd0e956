"""SimHash near-dedup with an inverted index on positional bytes.

A fingerprint has 64 bits, 8 bytes at fixed positions. Two that differ in at most DISTANCE = 2 bits differ in at most two bytes, so they
share at least MATCHES = 6 positional bytes. The bytes go in four pairs of positions, of which at least two pairs are equal: each
fingerprint is listed under the six keys of two such pairs. Inside a list, the shared positional bytes of a pair are tallied,
pairs under the guaranteed number are dropped, the others verified by counting their differing bits; of the links of a list one goes out
for each member joined, never all pairs. Distinct fingerprints are listed, once each, whatever the number of their documents.

A list of over MOST fingerprints is not compared pair by pair: its members are listed again under keys of six bytes (the four and any
two more). These lists have reached the tally already; their members differ in two bytes, so a list has 65,536 members at most
and each member's neighbours are looked up in a table of that size. No link is lost, and work stays in proportion to the rows.

Defined cases: null or blank text has fingerprint 0 and is linked like any other; fewer than `size` words are one shingle; a very long text is whole, held by one
task; equal rows are linked; a null doc_id is never the smallest unless all are null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .shared import HOT, lookup, materialize

SIZE = 3
SEED = 42
DISTANCE, MATCHES = 2, 6
MOST = 512
RUN = 255  # shingles whose bits fit counters of one byte
PAIRS = [(0, 1), (2, 3), (4, 5), (6, 7)]
FOURS = [a + b for a, b in itertools.combinations(PAIRS, 2)]
SPREAD = np.array([sum((x >> j & 1) << 8 * j for j in range(8)) for x in range(256)], np.uint64)  # bit j of a byte as byte j
NEAR = np.array([m for m in range(1, 1 << 16) if m.bit_count() <= DISTANCE])


def joined_words(chunk: K.Chunk, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of each text with one space between, and text, start and end of each shingle there, repeats included."""
    w = K.words(chunk, True)
    length = w.ends - w.starts
    start = np.cumsum(length + 1) - (length + 1)
    joined = np.full(int((length + 1).sum()), 0x20, np.uint8)
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    joined[np.repeat(start, length) + at] = K.LOWER[chunk.raw[np.repeat(w.starts, length) + at]]
    n = np.where(w.counts > 0, np.maximum(1, w.counts - size + 1), 0)
    doc = np.repeat(np.arange(chunk.n), n)
    word = np.arange(len(doc)) + np.repeat((np.cumsum(w.counts) - w.counts) - (np.cumsum(n) - n), n)
    last = word + np.minimum(size, w.counts[doc]) - 1
    return joined.tobytes(), doc, start[word], start[last] + length[last]


def fingerprints(chunk: K.Chunk, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Number of shingles and fingerprint of each text."""
    joined, doc, start, end = joined_words(chunk, size)
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end.tolist())], np.uint64)
    n = np.bincount(doc, minlength=chunk.n)
    out = np.zeros(chunk.n, np.uint64)
    if not len(h):
        return n, out
    first = np.cumsum(n) - n
    cut = np.nonzero((np.arange(len(h)) - first[doc]) % RUN == 0)[0]  # runs of RUN shingles of a text
    runs = np.add.reduceat(SPREAD[h.view(np.uint8).reshape(-1, 8)], cut)
    bits = runs.view(np.uint8).reshape(len(cut), 64)
    own = np.nonzero(n)[0]
    ones = np.add.reduceat(bits.astype(np.int64), np.searchsorted(doc[cut], own))
    out[own] = np.packbits(2 * ones > n[own][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return n, out


def hashed(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_shingles, fp for each row of docs."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in K.chunks(K.column(batch, "text")):
                n, fp = fingerprints(c, size)
                yield pa.RecordBatch.from_arrays([K.column(batch, "doc_id").slice(c.first, c.n), pa.array(n.astype(np.int64)), pa.array(fp.view(np.int64))], ["doc_id", "n_shingles", "fp"])
        K.release()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_shingles long, fp long")


def mask(positions: tuple[int, ...]) -> int:
    """The bytes at these positions, as a signed number of 64 bits."""
    x = sum(0xFF << 8 * p for p in positions)
    return x - 2**64 if x >> 63 else x


def listed(fps: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """fp, key for each set of positions: the set and the bytes there."""
    keys = [F.struct(F.lit(mask(s)).cast("long").alias("at"), F.col("fp").bitwiseAND(F.lit(mask(s)).cast("long")).alias("bytes")) for s in sets]
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def widened(rows: DataFrame) -> DataFrame:
    """rows: fp, key of four bytes. fp, key for each set of these and two more."""
    more = {s: [tuple(sorted(s + two)) for two in itertools.combinations([p for p in range(8) if p not in s], 2)] for s in FOURS}
    sets = F.create_map(*[x for s, wide in more.items() for x in (F.lit(mask(s)).cast("long"), F.array(*[F.lit(mask(w)).cast("long") for w in wide]))])
    each = rows.select("fp", F.explode(sets[F.col("key.at")]).alias("at"))
    return each.select("fp", F.struct("at", F.col("fp").bitwiseAND(F.col("at")).alias("bytes")).alias("key")).distinct()


def tallied(fp: np.ndarray) -> list[tuple[int, int]]:
    """Links among the distinct fingerprints of one list, each member with the first of its component."""
    own = fp.view(np.uint8).reshape(-1, 8)
    shared = np.zeros((len(fp), len(fp)), np.uint8)
    for p in range(8):
        shared += own[:, None, p] == own[None, :, p]
    a, b = np.nonzero(shared >= MATCHES)
    near = np.bitwise_count(fp[a] ^ fp[b]) <= DISTANCE
    return starred(len(fp), a[near], b[near])


def neighbours(fp: np.ndarray) -> list[tuple[int, int]]:
    """The same for fingerprints that differ in two bytes only, whose other values are looked up in a table of all of these."""
    moving = np.bitwise_or.reduce(fp ^ fp[0])
    low, high = ([p for p in range(8) if int(moving) >> 8 * p & 0xFF] + [0, 0])[:2]
    value = (fp >> np.uint64(8 * low) & np.uint64(0xFF)).astype(np.int64) | (fp >> np.uint64(8 * high) & np.uint64(0xFF)).astype(np.int64) << 8
    if low == high:
        value &= 0xFF
    at = np.full(1 << 16, -1)
    at[value] = np.arange(len(fp))
    label = np.arange(len(fp))
    while True:
        before = label.copy()
        for m in NEAR:
            to = at[value ^ m]
            own = np.nonzero(to >= 0)[0]
            label[own] = np.minimum(label[own], label[to[own]])
        label = label[label]
        if (label == before).all():
            return [(int(a), k) for k, a in enumerate(label) if a != k]


def starred(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        label = label[label]
        if (label == before).all():
            return [(int(x), k) for k, x in enumerate(label) if x != k]


def linked(rows: DataFrame, wide: bool) -> DataFrame:
    """rows: fp, key. a, b: links inside each list; lists have MOST members at most, or differ in two bytes only."""
    within = neighbours if wide else tallied

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)

        def links(rows: np.ndarray) -> pa.RecordBatch:
            cut = np.nonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1), [True]]))[0] if len(rows) else np.zeros(1, np.int64)
            size = np.diff(cut)
            fp = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
            two = cut[:-1][size == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= DISTANCE]
            a, b = [fp[two]], [fp[two + 1]]
            for at, n in zip(cut[:-1][size > 2].tolist(), size[size > 2].tolist()):
                found = np.array(within(fp[at : at + n]), np.int64).reshape(-1, 2)
                a.append(fp[at + found[:, 0]])
                b.append(fp[at + found[:, 1]])
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

        for batch in batches:
            new = np.stack([K.column(batch, c).to_numpy() for c in ("at", "bytes", "fp")], axis=1)
            held = np.concatenate([held, new])
            whole = np.nonzero((held[1:, :2] != held[:-1, :2]).any(axis=1))[0]
            if len(whole):  # the last list may go on in the next batch
                yield links(held[: whole[-1] + 1])
                held = held[whole[-1] + 1 :]
        yield links(held)
        K.release()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("key.at", "key.bytes", "fp").repartition(parts, "at", "bytes").sortWithinPartitions("at", "bytes", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, total: int, most: int = MOST) -> DataFrame:
    """fps: fp, each once, written. a, b: links that join all fingerprints of a component."""
    index = listed(fps, FOURS)
    crowd = materialize(index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > most), "crowded", total)
    if crowd.isEmpty():
        return linked(index, wide=False)
    hot = F.col("n") * HOT > len(FOURS) * total
    few = index.join(F.broadcast(crowd.filter(hot).select("key")), "key", "left_anti").join(crowd.filter(~hot).select("key"), "key", "left_anti")  # HOT keys at most
    many = lookup(index, crowd, "key", len(FOURS) * total).select("fp", "key")
    return linked(few, wide=False).unionByName(linked(widened(many), wide=True))


def resolve(docs: DataFrame, size: int = SIZE, most: int = MOST) -> DataFrame:
    """doc_id, n_shingles, fingerprint, component_id, group_rows (documents with that fingerprint): one row for each row of docs."""
    rows = materialize(hashed(docs, size), "fingerprints")
    classes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    total = classes.count()
    joined = components(links(classes.select("fp"), total, most))
    rooted = classes.join(joined.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialize(rooted, "rooted", total)
    least = materialize(rooted.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("size")), "least", total)
    named = materialize(lookup(rooted, least, "root", total, "size").select("fp", "component_id", "n"), "named", total)
    out = lookup(rows, named, "fp", rows.count())
    return out.select("doc_id", "n_shingles", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", F.col("n").alias("group_rows"))
