"""Quality classifier by importance resampling.

Tokens (runs of punctuation or of other characters, A-Z lower-cased) and pairs of neighbours are
hashed into `buckets`. The target model is counted on a bounded sample of labelled good documents,
the raw model on every document. A document's log weight is the sum over its n-grams of
log p_target - log p_raw, where both counts, brought to the same total, get `smoothing` more. An n-gram
counts 0 unless its target count is SURE deviations from what the raw model expects: differences that
chance explains would add up over a long text. Gumbel top-k takes
the k documents with the largest log weight + Gumbel noise hashed from (seed, doc_id): a sample
without replacement in proportion to the weights. k is `keep` x rows, or by default the number of documents
that are above all but a LOST share of the labelled good ones (quality 1, not toxic).

Defined cases: a null or empty text has no n-grams and log weight 0; a null doc_id hashes as empty;
rows equal in doc_id and text tie, and all rows that tie with the k-th stay; a very long text is whole, one row of one task; without
good labels, every log weight is 0, and all rows are kept unless `keep` is given; an empty table gives no rows; other columns are carried by `select`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import materialize

BUCKETS = 1 << 18
LABELLED = 20_000
SMOOTHING = 3.0
SURE = 3.0
LOST = 0.003
SEED = 11


def features(chunk: K.Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of each token and each pair of neighbours."""
    w = K.tokens(chunk)
    pair = np.nonzero(w.doc[1:] == w.doc[:-1])[0]
    both = K.mix(w.hashes[pair] * K.U(0x100000001B3) + w.hashes[pair + 1])
    return np.concatenate([w.doc, w.doc[pair]]), (np.concatenate([w.hashes, both]) >> K.U(32)).astype(np.int64) % buckets


def sample_labels(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """At most `most` labelled rows, those with the smallest hash of doc_id: doc_id, good (quality 1 and not toxic)."""
    good = (F.coalesce("quality", F.lit(0)) == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    rows = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.min(good).alias("good"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def models(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, most: int = LABELLED) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Counts of the target and of the raw text by bucket, and the ids of the labelled good rows. Only `buckets` rows reach the driver."""
    labelled = materialize(sample_labels(labels, most).filter("good"), "labels", most)
    marked = docs.select("doc_id", "text").join(F.broadcast(labelled), "doc_id", "left")  # `most` rows at most
    marked = marked.select("text", F.col("good").isNotNull().alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, raw = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = K.column(batch, "good").to_numpy(zero_copy_only=False).astype(bool)
            for c in K.chunks(K.column(batch, "text")):
                doc, bucket = features(c, buckets)
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[good[c.first + doc]], minlength=buckets)
        at = np.nonzero(raw)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(target[at]), pa.array(raw[at])], ["bucket", "target", "raw"])
        K.release()

    found = marked.mapInArrow(count, "bucket long, target long, raw long").groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))
    pdf = found.toPandas()
    target, raw = np.zeros(buckets), np.zeros(buckets)
    target[pdf["bucket"].to_numpy(np.int64)], raw[pdf["bucket"].to_numpy(np.int64)] = pdf["target"].to_numpy(), pdf["raw"].to_numpy()
    return target, raw, labelled


def ratios(target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw of each bucket, 0 where the difference is not sure."""
    if not target.sum():
        return np.zeros(len(raw))
    expected = raw * (target.sum() / raw.sum())
    sure = np.abs(target - expected) >= SURE * np.sqrt(expected + 1)
    return np.where(sure, np.log(target + smoothing) - np.log(expected + smoothing), 0.0)


def log_weights(docs: DataFrame, target: np.ndarray, raw: np.ndarray, smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_weight, key = log_weight + Gumbel noise."""
    held = docs.sparkSession.sparkContext.broadcast(ratios(target, raw, smoothing))  # one number for each bucket
    kind = dict(docs.dtypes)["doc_id"]
    ided = docs.select("doc_id", "text", F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("h"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            n, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            for c in K.chunks(K.column(batch, "text")):
                doc, bucket = features(c, len(table))
                n[c.first : c.first + c.n] = np.bincount(doc, minlength=c.n)
                total[c.first : c.first + c.n] = np.bincount(doc, table[bucket], minlength=c.n)
            u = ((K.column(batch, "h").to_numpy().view(np.uint64) >> K.U(11)).astype(float) + 0.5) / 2.0**53
            yield pa.RecordBatch.from_arrays([K.column(batch, "doc_id"), pa.array(n), pa.array(total), pa.array(total - np.log(-np.log(u)))], ["doc_id", "n_grams", "log_weight", "key"])
        K.release()

    return ided.mapInArrow(score, f"doc_id {kind}, n_grams long, log_weight double, key double")


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The exact k-th largest of column `key`, by histograms of its order-preserving bits, 16 at a time."""

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = K.column(b, "key").to_numpy().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.where(x < 0, x ^ np.int64(2**63 - 1), x))], ["o"])

    rows = keys.select("key").mapInArrow(ordered, "o long")
    floor, left = None, k
    for shift in (48, 32, 16, 0):
        at = rows if floor is None else rows.filter(F.shiftright("o", shift + 16) == floor)
        counts = sorted(at.groupBy(F.shiftright("o", shift).alias("b")).count().collect(), reverse=True)  # at most 65,536 rows
        for b, n in counts:
            if n >= left:
                floor = b
                break
            left -= n
        else:
            return None
    x = np.int64(floor)
    return float((np.array([x if x >= 0 else x ^ np.int64(2**63 - 1)], np.int64)).view(np.float64)[0])


def classify(docs: DataFrame, labels: DataFrame, keep: float | None = None, buckets: int = BUCKETS, most: int = LABELLED, smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """doc_id, n_grams, log_weight, key, kept: one row for each row of docs."""
    target, raw, good = models(docs, labels, buckets, most)
    scored = materialize(log_weights(docs, target, raw, smoothing, seed), "weights")
    if keep is None:
        least = scored.join(F.broadcast(good), "doc_id").agg(F.percentile("key", F.lit(LOST))).first()[0]  # `most` ids at most; k is how many are above
    else:
        n = scored.count()
        k = min(n, int(np.ceil(keep * n)))
        least = kth_largest(scored, k) if 0 < k < n else -np.inf if k else np.inf
    return scored.withColumn("kept", F.lit(True) if least is None else F.col("key") >= F.lit(float(least)))


def select(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of docs that are kept, with their columns. Ids alone are compared; rows of one id share their fate if any of them is kept."""
    kept = classify(docs, labels, **options).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi")
