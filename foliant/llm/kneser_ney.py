"""Interpolated modified Kneser-Ney bigram model: counted in Spark, memory-mapped by the workers.

Training runs in three Spark jobs. (1) Words are counted; the vocabulary is written as sorted arrays of
64-bit hashes, cut by their leading bits into files of about a million; a word's id is its place.
(2) Bigrams are counted in each partition, packed by ranges into blocks (sorted,
differenced, compressed), shuffled and merged; each range is written as a sorted array of
packed pairs with counts, with totals of each first word. Ranges are cut by the words' counts, so each has
about PENDING tokens or fewer; a word of more is cut by second word, and its totals are added up. Where ranges and files begin stands in files, too. (3) The numbers of different first words of each word are
packed, shuffled and merged likewise. Workers map the files read-only, at most MAPS of them at a time, and search sorted queries in those files only
that may hold them.
The files lie in the shared folder (spark.checkpoint.dir), which must be mounted as files on all workers.

Training tokens of a text are its words (A-Z lower-cased) and one end; the first word follows a begin mark.
The unigram level is the continuation distribution, interpolated with 1 / (V + 1).

Defined cases: a null or empty text has the end token only; a null doc_id is held out like id "";
rows are scored one by one, equal rows alike; a very long text is whole, one row of one task; without training rows, each token has probability 1; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from . import kernel as K
from .shared import materialize

END = K.U(0x5E17D1CE0FEED5E1)
PER_FILE = 1 << 20
PENDING = 4 << 20
MAPS = 4096
_open: dict[str, "Files"] = {}


@dataclass
class Model:
    """What goes with every task: the folder and a few sums, whatever the number of files."""

    path: str
    bits: int  # leading bits of a hash that name its vocabulary file
    size: int  # V
    tokens: int
    discounts: tuple[float, float, float]
    below: tuple[float, float, float]  # discounts of the continuation counts
    types: int  # different bigrams
    back: float  # weight of 1 / (V + 1) in the unigram level


def save(path: str, values: np.ndarray) -> None:
    """Whole or not at all, so a task that is run again does no harm."""
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, values)
    os.replace(part, path)


class Files:
    """The arrays of a model in this worker, mapped when first used; of all but those of the whole model, the least lately used go beyond MAPS."""

    def __init__(self, model: Model):
        self.model, self.maps, self.kept = model, {}, {}

    def get(self, name: str) -> np.ndarray:
        found = self.maps.pop(name, None)
        if found is None:
            found = np.load(f"{self.model.path}/{name}.npy", mmap_mode="r")
            while len(self.maps) >= MAPS:
                del self.maps[next(iter(self.maps))]
        self.maps[name] = found
        return found

    def whole(self, name: str) -> np.ndarray:
        """starts: first id of each vocabulary file, and V. cuts: packed pairs at which ranges begin, and the end of all. full: which ranges have
        bigrams. hot: word, total, n1, n2, n3 of first words that are cut by second word, in order."""
        if name not in self.kept:
            self.kept[name] = np.load(f"{self.model.path}/{name}.npy", mmap_mode="r")
        return self.kept[name]

    def low(self, k: int) -> int:
        """The first word at which range k begins."""
        return int(self.whole("cuts")[k]) // (self.model.size + 1)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of sorted hashes, -1 where unknown."""
        out, starts = np.full(len(hashes), -1, np.int64), self.whole("starts")
        file = (hashes >> K.U(64 - self.model.bits)).astype(np.int64) if self.model.bits else np.zeros(len(hashes), np.int64)
        for k, at in runs(file):
            if starts[k] < starts[k + 1]:
                known, asked = self.get(f"word-{k}"), hashes[at]
                place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
                out[at] = np.where(known[place] == asked, place + starts[k], -1)
        return out

    def by_word(self, name: str, ids: np.ndarray) -> np.ndarray:
        """Values of sorted ids; ids cut as the vocabulary files."""
        out, starts = np.zeros(len(ids), np.int64), self.whole("starts")
        for k, at in runs(np.searchsorted(starts, ids, "right") - 1):
            out[at] = self.get(f"{name}-{k}")[ids[at] - starts[k]]
        return out

    def pairs(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of bigrams sorted by (first, second), and total, n1, n2, n3 of their first words. Ranges without bigrams have no files."""
        counts, sums = np.zeros(len(first), np.int64), np.zeros((4, len(first)), np.int64)
        asked, full, hot = first * np.int64(self.model.size + 1) + second, self.whole("full"), self.whole("hot")
        for k, at in runs(np.searchsorted(self.whole("cuts"), asked, "right") - 1):
            if k < len(full) and full[k]:
                known = self.get(f"pair-{k}")
                place = np.minimum(np.searchsorted(known, asked[at]), len(known) - 1)
                counts[at] = np.where(known[place] == asked[at], self.get(f"times-{k}")[place], 0)
                sums[:, at] = self.get(f"first-{k}")[:, first[at] - self.low(k)]
        if hot.shape[1]:
            at = np.minimum(np.searchsorted(hot[0], first), hot.shape[1] - 1)
            own = hot[0][at] == first
            sums[:, own] = hot[1:, at[own]]
        return counts, sums


def runs(sorted_: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each value that occurs, with where it stands: as many steps as different values."""
    if len(sorted_):
        cut = np.nonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1], [True]]))[0]
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            yield int(sorted_[a]), slice(a, b)


def opened(model: Model) -> Files:
    if model.path not in _open or _open[model.path].model != model:  # it is completed while it is trained
        _open.clear()
        _open[model.path] = Files(model)
    return _open[model.path]


def pack(values: np.ndarray) -> bytes:
    """Sorted or small integers: differences, compressed."""
    return zstandard.compress(np.diff(values.astype(np.int64), prepend=np.int64(0)).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(data), np.int64))


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.nonzero(np.concatenate([[True], k[1:] != k[:-1]]))[0] if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


class Tally:
    """Counts of keys, merged now and then so that they stay small."""

    def __init__(self, kind) -> None:
        self.keys, self.counts, self.pending = [np.zeros(0, kind)], [np.zeros(0, np.int64)], 0

    def add(self, values: np.ndarray) -> None:
        k, c = np.unique(values, return_counts=True)
        self.keys.append(k)
        self.counts.append(c)
        self.pending += len(k)
        if self.pending > PENDING:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        k, c = summed(self.keys, self.counts)
        self.keys, self.counts, self.pending = [k], [c], 0
        return k, c


def tokens(chunk: K.Chunk, files: Files) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, id, id of the token before) of each token with the end tokens; unknown is -1, begin is V."""
    w = K.words(chunk, True)
    distinct, which = np.unique(np.concatenate([w.hashes, [END]]), return_inverse=True)
    ids = files.ids(distinct)[which]
    ends = np.cumsum(w.counts + 1) - 1
    out = np.full(len(w.hashes) + chunk.n, ids[-1])
    inner = np.ones(len(out), bool)
    inner[ends] = False
    out[inner] = ids[:-1]
    before = np.concatenate([[0], out[:-1]])
    before[np.concatenate([[0], ends[:-1] + 1])] = files.model.size
    return np.repeat(np.arange(chunk.n), w.counts + 1), out, before


def count_words(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, ends = Tally(np.uint64), 0
        for batch in batches:
            for c in K.chunks(batch.column(0)):
                tally.add(K.words(c, True).hashes)
                ends += c.n
        k, n = tally.merge()
        if ends:
            k, n = np.concatenate([k, [END]]), np.concatenate([n, [ends]])
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(n)], ["w", "n"])
        K.release()

    return docs.select("text").mapInArrow(run, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))


def write_words(counts: DataFrame, path: str) -> tuple[int, list[int], list[tuple[int, int]], int]:
    """Vocabulary files of sorted hashes (word-k) and counts (count-k). Bits of the cut, first ids, marks (id, count so far: about four for PENDING tokens), tokens."""
    bits = max(0, int(np.ceil(np.log2(max(1, counts.count() / PER_FILE)))))
    file = F.shiftrightunsigned("w", 64 - bits).cast("int") if bits else F.lit(0)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        k, w = int(pdf["k"].iloc[0]), pdf["w"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(w)
        save(f"{path}/word-{k}.npy", w[order])
        save(f"{path}/count-{k}.npy", pdf["n"].to_numpy(np.int64)[order])
        so_far = np.cumsum(pdf["n"].to_numpy(np.int64)[order])
        steps = so_far // max(1, PENDING // 4)
        at = np.nonzero(np.diff(steps, prepend=0))[0]  # the words at which the count passes a step
        return pd.DataFrame({"k": [k], "words": [len(w)], "tokens": [int(so_far[-1])], "at": [at.tolist()], "upto": [so_far[at].tolist()], "n": [pdf["n"].to_numpy(np.int64)[order][at].tolist()]})

    kind = "k int, words long, tokens long, at array<long>, upto array<long>, n array<long>"
    done = materialize(counts.withColumn("k", file).groupBy("k").applyInPandas(write, kind), "words").collect()  # a row for each file, four numbers for PENDING tokens
    of, starts, marks, total = {r["k"]: r for r in done}, [0], [], 0
    for k in range(1 << bits):
        if k in of:
            marks += [(starts[-1] + i, n) for i, n in zip(of[k]["at"], of[k]["n"])]
            total += of[k]["tokens"]
        starts.append(starts[-1] + (of[k]["words"] if k in of else 0))
    return bits, starts, marks, total


def cut_ranges(marks: list[tuple[int, int]], size: int) -> tuple[list[int], list[int]]:
    """The packed pairs at which ranges begin, and the first words that lie in several. Every fourth mark ends a range; a word of more than PENDING
    tokens has ranges of its own, cut at the marks as second words, which are about evenly frequent."""
    wide, cuts, hot, since = size + 1, {0}, [], 0
    for word, n in marks:
        since += 1
        if n > PENDING:
            parts = -(-n // PENDING)
            seconds = {marks[j * len(marks) // parts][0] for j in range(1, parts)}
            cuts |= {word * wide, (word + 1) * wide} | {word * wide + x for x in seconds}
            hot.append(word)
        elif since >= 4:
            cuts.add((word + 1) * wide)
        since = 0 if n > PENDING or since >= 4 else since
    return sorted(cuts | {size * wide, wide * wide}), hot


def of_counts(c: np.ndarray) -> list[int]:
    return [int((c == k).sum()) for k in (1, 2, 3, 4)]


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Chen and Goodman's three discounts from the numbers of n-grams seen 1, 2, 3 and 4 times; half steps where one is missing."""
    if not all(n):
        return 0.5, 0.75, 0.9
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) for k in (1, 2, 3))


def discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3)]


def count_pairs(docs: DataFrame, model: Model) -> DataFrame:
    """k, keys, counts: packed bigram counts of a partition in range k of first words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, files, wide = Tally(np.int64), opened(model), np.int64(model.size + 1)
        for batch in batches:
            for c in K.chunks(batch.column(0)):
                _, ids, before = tokens(c, files)
                tally.add(before * wide + ids)
        keys, counts = tally.merge()
        rows = [(k, pack(keys[at]), pack(counts[at])) for k, at in runs(np.searchsorted(files.whole("cuts"), keys, "right") - 1)]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[j] for r in rows], pa.binary()) for j in (1, 2))], ["k", "keys", "counts"])
        K.release()

    return docs.select("text").mapInArrow(run, "k int, keys binary, counts binary")


def write_pairs(packed: DataFrame, model: Model, hot: list[int]) -> DataFrame:
    """Writes pair-k, times-k and first-k. Rows: j, ids, counts (packed numbers of first words by word, in vocabulary file j), or, with j null, sums, and
    with j -1 the word and the range's part of the totals of a word in several ranges."""

    own = set(hot)

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        k, wide, files = int(pdf["k"].iloc[0]), np.int64(model.size + 1), opened(model)
        keys, counts = summed([unpack(x) for x in pdf["keys"]], [unpack(x) for x in pdf["counts"]])
        low = files.low(k)
        n = -(-int(files.whole("cuts")[k + 1]) // int(wide)) - low
        first, second = keys // wide - low, keys % wide
        by = lambda weights=None: np.bincount(first, weights, minlength=n).astype(np.int64)
        save(f"{model.path}/pair-{k}.npy", keys)
        save(f"{model.path}/times-{k}.npy", counts.astype(np.uint32 if counts.max(initial=0) < 2**32 else np.int64))
        totals = np.stack([by(counts), by(counts == 1), by(counts == 2), by(counts >= 3)])
        save(f"{model.path}/first-{k}.npy", totals)
        words, of = np.unique(second, return_counts=True)
        rows = [(j, pack(words[at]), pack(of[at]), None) for j, at in runs(np.searchsorted(files.whole("starts"), words, "right") - 1)]
        rows.append((None, None, None, [k, len(keys), *of_counts(counts)]))
        rows += [(-1, None, None, [low, *totals[:, 0].tolist()])] if low in own and n == 1 else []
        return pd.DataFrame(rows, columns=["j", "ids", "counts", "sums"]).astype({"j": "Int32"})

    return packed.groupBy("k").applyInPandas(write, "j int, ids binary, counts binary, sums array<long>")


def write_below(rows: DataFrame, model: Model) -> DataFrame:
    """Writes below-j: for each word, after how many different tokens it comes."""

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        j = int(pdf["j"].iloc[0])
        ids, counts = summed([unpack(x) for x in pdf["ids"]], [unpack(x) for x in pdf["counts"]])
        starts = opened(model).whole("starts")
        dense = np.zeros(starts[j + 1] - starts[j], np.int64)
        dense[ids - starts[j]] = counts
        save(f"{model.path}/below-{j}.npy", dense)
        return pd.DataFrame({"sums": [[int((dense >= 3).sum()), *of_counts(dense)]]})

    return rows.filter("j >= 0").groupBy("j").applyInPandas(write, "sums array<long>")


def train(docs: DataFrame, folder: str | None = None) -> Model:
    """The model of all rows of docs (text)."""
    folder = folder or shared_dir(docs.sparkSession)
    path = folder.removeprefix("file://").removeprefix("file:")
    if "://" in path:
        raise ValueError(f"workers map the model's files, so its folder must be mounted on them; {folder} is not a file path")
    path = f"{path}/foliant/ngrams-{uuid.uuid4().hex}"
    os.makedirs(path)
    counts = materialize(count_words(docs), "counts")
    bits, starts, marks, n = write_words(counts, path)
    texts = counts.filter(F.col("w") == int(END.astype(np.int64))).first()
    cuts, hot = cut_ranges([*marks, (starts[-1], texts["n"] if texts else 0)], starts[-1])  # the begin mark comes last, once a text
    save(f"{path}/starts.npy", np.array(starts, np.int64))
    save(f"{path}/cuts.npy", np.array(cuts, np.int64))
    model = Model(path, bits, starts[-1], n, (0.5, 0.75, 0.9), (0.5, 0.75, 0.9), 0, 1.0)
    if not n:
        return model
    rows = materialize(write_pairs(count_pairs(docs, model), model, hot), "pairs")
    totals: dict[int, list[int]] = {}
    for word, *of in (r["sums"] for r in rows.filter("j = -1").select("sums").collect()):  # a row for each range of a hot word
        totals[word] = [a + b for a, b in zip(totals.get(word, [0] * 4), of)]
    full = np.zeros(len(cuts) - 1, bool)
    full[[r["k"] for r in rows.filter("j is null").select(F.get("sums", F.lit(0)).alias("k")).collect()]] = True  # a row for each range
    save(f"{path}/full.npy", full)
    save(f"{path}/hot.npy", np.array([(w, *of) for w, of in sorted(totals.items())], np.int64).reshape(-1, 5).T)
    part = lambda of, m: [F.sum(F.get("sums", F.lit(i))).alias(str(i)) for i in range(of, m)]
    types, *of = rows.filter("j is null").agg(*part(1, 6)).first()
    three, *below = materialize(write_below(rows, model), "below").agg(*part(0, 5)).first()
    d = discounts(below)
    return Model(path, bits, starts[-1], n, discounts(of), d, types, (d[0] * below[0] + d[1] * below[1] + d[2] * three) / types)


def score_chunk(chunk: K.Chunk, files: Files) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """n_tokens, n_known, base score and score of each text."""
    m, n_docs = files.model, chunk.n
    doc, ids, before = tokens(chunk, files)
    wide = np.int64(m.size + 2)
    keys, which = np.unique((before + 1) * wide + ids + 1, return_inverse=True)
    first, second = keys // wide - 1, keys % wide - 1
    words, place = np.unique(second, return_inverse=True)
    seen, below = files.by_word("count", words[words >= 0]), files.by_word("below", words[words >= 0])
    pad = np.zeros(int((words < 0).sum()), np.int64)
    seen, below = np.concatenate([pad, seen]), np.concatenate([pad, below])
    base = np.log10((seen + 0.1) / (m.tokens + 0.1 * (m.size + 1)))
    p = np.maximum(below - discount(below, m.below), 0) / max(m.types, 1) + m.back / (m.size + 1)
    p = p[place]
    both = np.nonzero((first >= 0) & (second >= 0))[0]
    counts, sums = np.zeros(len(keys), np.int64), np.zeros((4, len(keys)), np.int64)
    known = np.nonzero(first >= 0)[0]
    counts[known], sums[:, known] = files.pairs(first[known], np.maximum(second, 0)[known])
    counts[np.setdiff1d(known, both, assume_unique=True)] = 0
    total = np.maximum(sums[0], 1)
    back = np.where(sums[0] > 0, (np.array(m.discounts) @ sums[1:]) / total, 1.0)
    p = np.maximum(counts - discount(counts, m.discounts), 0) / total + back * p
    add = lambda x: np.bincount(doc, x, minlength=n_docs)
    return np.bincount(doc, minlength=n_docs), add(seen[place][which] > 0).astype(np.int64), add(base[place][which]), add(np.log10(p)[which])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity for each row of docs."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = opened(model)
        for batch in batches:
            for c in K.chunks(batch.column(1)):
                if model.tokens:
                    n, known, base, total = score_chunk(c, files)
                else:
                    n = K.words(c, True).counts + 1
                    known, base, total = np.zeros(c.n, np.int64), np.zeros(c.n), np.zeros(c.n)
                numbers = [n.astype(np.int64), known, np.full(c.n, model.tokens), base, total, 10.0 ** (-total / n)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(c.first, c.n), *map(pa.array, numbers)], ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])
        K.release()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def held_out(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


def train_and_score(docs: DataFrame) -> DataFrame:
    """Learns from nine tenths of the rows by their id's hash and scores all."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    return score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
