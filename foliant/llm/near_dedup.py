"""MinHash near-dedup with fast similarity sketches.

A sketch has T coordinates. In round i each shingle is hashed to a bin and a value, and a bin that
no earlier round has filled takes the least value; after T rounds, round T + j sends every shingle to
bin j, so all coordinates fill. Sketches are cut into bands of `band_rows` coordinates; documents
that share a band are candidates. A pair at the threshold shares none with a chance under MISSED
(0.85: 6e-9 with 40 bands of 6; 0.8: 5e-9 with 48 bands of 5).

Candidates are joined into clusters (links to the least member of each bucket, then connected
components), so hot buckets give one row a member, not pairs. Clusters are verified on
their full shingle sets, in blocks of about BLOCK members inside one task each; in clusters of several
blocks, about PIVOTS members lie in every block and tie the blocks' links together. Where links do not
join such a cluster, as in pages of one template that are alike but no near copies, it is narrowed
to the clusters that rare tokens make (`prefixes`), which are verified likewise; only if one of these has
several blocks and is not joined either, members outside its largest component are held against every block, in
pairs of blocks. So no link is lost. Equal sets are one class from the start.

Sets are of 64-bit fingerprints, classes have 128-bit ones.

Defined cases: null or blank text has an empty set and is linked with nothing; a text of fewer than
`size` words is one shingle; a very long text is whole, held by one task; rows with equal sets are linked; of rows equal in doc_id all are
kept or none; a null doc_id is never the smallest unless all are null; an empty table gives no rows; other columns are ignored here
and carried by `dedup`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .components import components
from .shared import lookup, materialize, one_each

SIZE = 5
THRESHOLD = 80
T = 240
MISSED = 1e-8
BLOCK, BLOCK_SHINGLES = 512, 2_000_000
PIVOTS = 64
RARE = 20_000
EDGES = "a binary, b binary"


def sketch(docs: np.ndarray, hashes: np.ndarray, n_docs: int, t: int = T) -> np.ndarray:
    """n_docs x t values (round << 32 | low bits). docs, hashes: distinct elements by document."""
    out = np.full(n_docs * t, K.U(2**64 - 1), np.uint64)
    at, h = docs, hashes
    for i in range(2 * t):
        if not len(at):
            break
        v = K.mix(h + K.U((i + 1) * 0x9E3779B97F4A7C15 % 2**64))
        place = ((v >> K.U(32)) * K.U(t) >> K.U(32)).astype(np.int64) if i < t else np.full(len(v), i - t)
        place += at * t
        value = (v & K.U(0xFFFFFFFF)) | K.U(i << 32)
        free = out[place] >= K.U(i << 32)
        np.minimum.at(out, place[free], value[free])
        if i % 4 == 0 or i < 4:
            open_ = (out.reshape(n_docs, t) == K.U(2**64 - 1)).any(axis=1)[at]
            at, h = at[open_], h[open_]
    return out.reshape(n_docs, t)


def band_rows(threshold: int, t: int = T) -> int:
    """The most rows a band may have so that a pair at the threshold is missed with a chance under MISSED; 1 if none is that good."""
    return max((r for r in range(1, t + 1) if t % r == 0 and (1 - (threshold / 100) ** r) ** (t // r) < MISSED), default=1)


def bands(values: np.ndarray, rows: int) -> np.ndarray:
    n, t = values.shape
    parts = values.reshape(n, t // rows, rows)
    key = np.broadcast_to(np.arange(t // rows, dtype=np.uint64), (n, t // rows)).copy()
    for j in range(rows):
        key = K.mix(key * K.U(0x100000001B3) + parts[:, :, j])
    return key.view(np.int64)


def sets(chunk: K.Chunk, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, hashes = K.shingles(K.words(chunk, True), size)
    return docs, hashes, np.searchsorted(docs, np.arange(chunk.n + 1))


def fingerprint(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def text_hash() -> F.Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def sketches(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, h (a hash of the text), n_shingles, fp (null where the set is empty), bands."""
    kind, rows = dict(docs.dtypes)["doc_id"], band_rows(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in K.chunks(K.column(batch, "text")):
                docs, hashes, cut = sets(c, size)
                keys = bands(sketch(docs, hashes, c.n), rows)
                n = np.diff(cut)
                fps = pa.array([fingerprint(hashes[cut[d] : cut[d + 1]]) if n[d] else None for d in range(c.n)], pa.binary())
                lists = K.list_array(pa.array(keys.reshape(-1)), np.arange(c.n + 1) * keys.shape[1])
                own = [K.column(batch, x).slice(c.first, c.n) for x in ("doc_id", "h")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(n.astype(np.int64)), fps, lists], ["doc_id", "h", "n_shingles", "fp", "bands"])
        K.release()

    return docs.select("doc_id", "text", text_hash().alias("h")).mapInArrow(run, f"doc_id {kind}, h long, n_shingles long, fp binary, bands array<long>")


def links(owned: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """The components of the links among sorted sets, each member with its component's first: 100 * intersection >= threshold * union."""
    m, n = len(owned), np.array([len(x) for x in owned])
    h = np.concatenate(owned)
    who = np.repeat(np.arange(m), n)
    order = np.argsort(h, kind="stable")
    h, who = h[order], who[order]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    col = np.cumsum(new) - 1
    shared = np.bincount(col)[col] > 1
    who, col = who[shared], col[shared]
    both = np.zeros((m, m), np.float32)
    if len(col):
        col = np.cumsum(np.concatenate([[True], col[1:] != col[:-1]])) - 1
        width = 4096
        cuts = np.searchsorted(col, np.arange(0, col[-1] + width + 1, width))
        for k in range(len(cuts) - 1):
            x = np.zeros((m, width), np.float32)
            x[who[cuts[k] : cuts[k + 1]], col[cuts[k] : cuts[k + 1]] - k * width] = 1
            both += x @ x.T
    inter = both.astype(np.int64)
    linked = 100 * inter >= threshold * (n[:, None] + n[None, :] - inter)
    left, found = np.ones(m, bool), []
    for start in range(m):
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo:
            near = np.nonzero(linked[todo.pop()] & left)[0]
            left[near] = False
            found += [(start, int(x)) for x in near]
            todo += near.tolist()
    return found


def verified(rows: DataFrame, keys: list[str], size: int, threshold: int) -> DataFrame:
    """rows: keys, fp, text. Links (a, b) inside each group of equal keys; a group is at most two blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, np.ndarray] = {}
        group = None

        def close() -> list[tuple[bytes, bytes]]:
            names = sorted(held)
            out = [(names[a], names[b]) for a, b in links([held[x] for x in names], threshold)] if len(held) > 1 else []
            held.clear()
            return out

        for batch in batches:
            found = []
            ids = list(zip(*[K.column(batch, k).to_pylist() for k in keys]))
            fps = K.column(batch, "fp").to_pylist()
            for c in K.chunks(K.column(batch, "text")):
                _, hashes, cut = sets(c, size)
                for d in range(c.n):
                    if ids[c.first + d] != group:
                        found += close()
                        group = ids[c.first + d]
                    own = hashes[cut[d] : cut[d + 1]]
                    if fingerprint(own) == fps[c.first + d]:  # else another row of the same doc_id
                        held[fps[c.first + d]] = own.copy()
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])
        found = close()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.binary()) for k in (0, 1)], ["a", "b"])
        K.release()

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, *keys).sortWithinPartitions(*keys)
    return dealt.select(*keys, "fp", "text").mapInArrow(run, EDGES)


def resolve(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of docs."""
    return resolved(docs, size, threshold).drop("h")


def placed(members: DataFrame) -> DataFrame:
    """members (cluster, fp, n, ...) with n_blocks, block (the own one) and blocks (for about PIVOTS members of a cluster of several, all)."""
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size"), F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("n_blocks"))
    total = members.count()
    out = lookup(members, materialize(sizes, "sizes", total), "cluster", total, "size")
    h = lambda seed: F.xxhash64("fp", F.lit(seed))
    pivot = F.pmod(h(3), F.ceil(F.col("size") / PIVOTS)) == 0
    out = out.withColumn("block", F.pmod(h(1), "n_blocks").cast("int"))
    return out.withColumn("blocks", F.when(pivot, F.sequence(F.lit(0), F.col("n_blocks") - 1)).otherwise(F.array("block"))).drop("size")


def settled(members: DataFrame, part: DataFrame) -> DataFrame:
    """The members of clusters that links do not join into one component, with root. part: the links' components."""
    known = members.join(part.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    total = members.count()
    known = materialize(known, "known", total)
    roots = known.groupBy("cluster").agg(F.min("root").alias("_least"), F.max("root").alias("_most"), F.count("*").alias("size"))
    roots = materialize(roots.filter("_least <> _most").select("cluster", "size"), "open", total)
    return known.limit(0) if roots.isEmpty() else lookup(known, roots, "cluster", total, "size").drop("size")


def prefixes(sets_: DataFrame, threshold: int) -> DataFrame:
    """sets_: cluster, root, fp, tokens. key, fp for each token of a set's prefix that sets of different roots have: any two sets of a cluster
    whose intersection is large enough share a token among the rarest n - ceil(threshold * n / 100) + 1 of each, by one order of all tokens
    (their number in the cluster, then themselves). So what all pages of a template have is not tried."""
    each = sets_.select("cluster", "root", "fp", F.explode("tokens").alias("token"))
    key = F.xxhash64("cluster", "token").alias("key")  # where two tokens meet in one key, more is tried
    counts = each.groupBy(key).agg(F.count("*").alias("n"), (F.min("root") != F.max("root")).alias("mixed"))
    counts = materialize(counts.filter("n > 1"), "tokens")
    hot = F.broadcast(counts.filter(F.col("n") * RARE > counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]).select("key", F.struct("n", "mixed").alias("_hot")))  # RARE rows at most
    own = each.select("fp", key, F.col("token")).join(hot, "key", "left")
    cold = own.filter("_hot is null").join(counts.hint("merge"), "key", "left").select("fp", "key", "token", "n", "mixed")
    own = own.filter("_hot is not null").select("fp", "key", "token", "_hot.n", "_hot.mixed").unionByName(cold)
    rank = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(1).cast("long")).alias("n"), "token", "key", "mixed")))
    size = F.size("t") - F.ceil(F.size("t") * threshold / 100).cast("int") + 1
    first = own.groupBy("fp").agg(rank.alias("t")).select("fp", F.explode(F.slice("t", 1, size)).alias("x"))
    return first.filter("x.mixed").select("x.key", "fp")


def tokens_of(texts: DataFrame, size: int) -> DataFrame:
    """texts: cluster, root, fp, text. cluster, root, fp, tokens (the set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in K.chunks(K.column(batch, "text")):
                _, hashes, cut = sets(c, size)
                own = [K.column(batch, x).slice(c.first, c.n) for x in ("cluster", "root", "fp")]
                yield pa.RecordBatch.from_arrays([*own, K.list_array(pa.array(hashes.view(np.int64)), cut)], ["cluster", "root", "fp", "tokens"])
        K.release()

    kind = dict(texts.dtypes)["cluster"]
    return texts.select("cluster", "root", "fp", "text").mapInArrow(run, f"cluster {kind}, root binary, fp binary, tokens array<long>")


def narrowed(members: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """cluster, fp, n: the members of unsettled clusters, in the smaller clusters that rare shared tokens make; those that share none are left out."""
    own = texts.select("fp", "text").join(members.select("fp", "cluster", "root"), "fp")
    tokens = materialize(prefixes(materialize(tokens_of(own, size), "sets"), threshold), "prefixes")
    linked = components(stars_of(tokens, "fp"))
    return members.select("fp", "n").join(linked.select(F.col("v").alias("fp"), F.col("root").alias("cluster")), "fp")


def stars_of(rows: DataFrame, member: str) -> DataFrame:
    """rows: key, member. a, b: each member of a key with the key's least; a row a member, whatever the key's size."""
    hubs = rows.groupBy("key").agg(F.min(member).alias("hub"), F.max(member).alias("_top"), F.count("*").alias("n")).filter("hub <> _top").select("key", "hub", "n")
    n = rows.count()
    met = lookup(rows, materialize(hubs, "hubs", n), "key", n)
    return met.filter(F.col(member) != F.col("hub")).select(F.col(member).alias("a"), F.col("hub").alias("b"))


def across(known: DataFrame, texts: DataFrame, size: int, threshold: int) -> DataFrame:
    """Links of the members outside each cluster's largest component with all of the cluster, in pairs of blocks."""
    total = known.count()
    sizes = known.groupBy("cluster", "root").count()
    core = sizes.groupBy("cluster").agg(F.max_by("root", F.struct("count", "root")).alias("core"), F.sum("count").alias("size"))
    known = lookup(known, materialize(core, "core", total), "cluster", total, "size").drop("size").withColumn("loose", F.col("root") != F.col("core"))
    count = lambda what: F.greatest(F.ceil(F.sum(what.cast("long")) / BLOCK), F.ceil(F.sum(F.when(what, F.col("n")).otherwise(0)) / BLOCK_SHINGLES), F.lit(0))
    known = materialize(known, "loose", total)
    sides = known.groupBy("cluster").agg(count(F.col("loose")).cast("int").alias("n_loose"), count(~F.col("loose")).cast("int").alias("n_core"), F.count("*").alias("size"))
    known = lookup(known, materialize(sides, "sides", total), "cluster", total, "size")
    at = F.pmod(F.xxhash64("fp", F.lit(2)), F.when(F.col("loose"), F.col("n_loose")).otherwise(F.col("n_core"))).cast("int")
    known = known.withColumn("at", at + F.when(F.col("loose"), 0).otherwise(F.col("n_loose")))
    # a block of loose members meets every block; blocks of the core do not meet each other
    loose = F.transform(F.sequence(F.lit(0), F.col("n_loose") + F.col("n_core") - 1), lambda j: F.struct(F.least("at", j).alias("x"), F.greatest("at", j).alias("y")))
    core_ = F.transform(F.sequence(F.lit(0), F.col("n_loose") - 1), lambda j: F.struct(j.alias("x"), F.col("at").alias("y")))
    second = known.withColumn("pair", F.explode(F.when(F.col("loose"), loose).otherwise(core_))).select("cluster", F.col("pair.x").alias("x"), F.col("pair.y").alias("y"), "fp")
    return verified(texts.select("fp", "text").join(second, "fp"), ["cluster", "x", "y"], size, threshold)


def resolved(docs: DataFrame, size: int, threshold: int) -> DataFrame:
    all_docs = materialize(sketches(docs, size, threshold), "sketches")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("rep")
    classes = all_docs.filter("fp is not null").groupBy("fp").agg(rep, F.min("n_shingles").alias("n"), F.count("*").alias("rows"), F.first("bands").alias("bands"))
    classes = materialize(classes.select("fp", F.col("rep.doc_id").alias("rep"), F.col("rep.h").alias("h"), "n", "rows", "bands", F.xxhash64("fp").alias("v")), "classes")
    clusters = components(stars_of(classes.select("v", F.explode("bands").alias("key")), "v")).select("v", F.col("root").alias("cluster"))
    members = classes.select("fp", F.col("rep").alias("_rep"), F.col("h").alias("_h"), "n", "v").join(clusters, "v").drop("v")
    total = classes.count()
    members = materialize(placed(materialize(members, "members", total)), "members", total)
    texts = docs.select("doc_id", text_hash().alias("h"), "text")
    at = members.select("_rep", "_h", "cluster", "block", "n_blocks", "fp", F.explode("blocks").alias("at")).hint("merge")
    held = texts.join(at, (texts["h"] == at["_h"]) & texts["doc_id"].eqNullSafe(at["_rep"])).select("cluster", "at", "fp", "text", ((F.col("n_blocks") > 1) & (F.col("at") == F.col("block"))).alias("many"))
    held = materialize(held, "member-texts")  # the one shuffle of texts; those of clusters of several blocks are read again below
    part = components(verified(held, ["cluster", "at"], size, threshold))

    many = members.filter("n_blocks > 1").select("cluster", "fp", "n")
    left = settled(many, part) if not many.isEmpty() else many
    if not left.isEmpty():
        texts = held.filter("many")
        total = left.count()
        left = materialize(placed(materialize(narrowed(left, texts, size, threshold), "narrowed", total)), "placed", total)
        own = texts.select("fp", "text").join(left.select("cluster", "fp", F.explode("blocks").alias("at")), "fp")
        part = joined(part, verified(own, ["cluster", "at"], size, threshold))
        many = left.filter("n_blocks > 1").select("cluster", "fp", "n")
        left = settled(many, part) if not many.isEmpty() else many
        if not left.isEmpty():
            part = joined(part, across(left, texts, size, threshold))

    named = classes.select("fp", "rep", "rows").join(part.select(F.col("v").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    total = classes.count()
    named = materialize(named, "named", total)
    least = materialize(named.groupBy("root").agg(F.min("rep").alias("component_id"), F.count("*").alias("n")), "least", total)
    named = materialize(lookup(named, least, "root", total).select("fp", "component_id", "rows"), "named", total)
    full, empty = all_docs.filter("fp is not null"), all_docs.filter("fp is null")
    met = lookup(full.drop("bands"), named, "fp", all_docs.count(), "rows").select("doc_id", "h", "n_shingles", "component_id")
    out = met.unionByName(empty.select("doc_id", "h", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def joined(part: DataFrame, links_: DataFrame) -> DataFrame:
    """Components (v, root) after more links (a, b)."""
    return components(part.select(F.col("v").alias("a"), F.col("root").alias("b")).unionByName(links_))


def dedup(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of docs that stay, one document of each group, with all their columns."""
    kept = resolved(docs, size, threshold).filter("kept").select(F.struct("doc_id", "h").alias("key"))
    own = docs.select(F.struct("*").alias("row"), F.struct("doc_id", text_hash().alias("h")).alias("key"), text_hash().alias("h"))
    return one_each(own.join(kept, "key", "left_semi"))
