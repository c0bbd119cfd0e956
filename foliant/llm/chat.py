"""Chat formatting over a prefix tree.

Conversations that begin with the same turns share the nodes of these turns. Each node's text is
emitted once, in depth-first order, at code points [dfs_start, dfs_end) of one stream; its position
ids start where its parent's end (pos_start), and it attends to itself and to its ancestors'
intervals. A member row names the leaf of each conversation.

A node's name is a polynomial hash of its turns' digests, at two points of the field of PRIME, so it is a running sum: rows are
range-sorted by conversation and turn, summed inside each partition, and each partition's first
conversation is then moved on by what lies before it. The way to a node is not stored turn by turn. Of a
node's children the one with the most conversations is heavy and comes first, so a heavy path is one
interval of the stream, and a node leaves heavy paths at most log2(conversations) times: its
sort key and its ancestors' intervals are that long. No task holds a conversation, no row holds its turns,
and nodes that very many rows name are looked up by broadcast.

Template: <|im_start|>ROLE\\nTEXT<|im_end|>\\n. In texts one backslash goes in after each `<` that is
followed by any backslashes and `|`; in roles % and newline are written %25 and %0A. Both are
undone by `unescape` and `unescape_role`.

Defined cases: null role or text counts as empty; rows go by (turn, role, text), null turn first;
equal rows are turns of their own; a null conv_id is a conversation; a very long text is whole, one row of one
task; an empty table gives no nodes; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import lookup, materialize, running_totals

START, END = "<|im_start|>", "<|im_end|>\n"
SEGMENT = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n$"
PRIME = 2**61 - 1  # a field: modulo a power of two, polynomials of some sequences are equal at every point
BASES = (0x0E3779B97F4A7C15, 0x12B2AE3D27D4EB4F)
SPAN = "array<struct<dfs_start:bigint,dfs_end:bigint>>"


@dataclass
class Forest:
    nodes: DataFrame  # node, parent, depth, segment, pos_start, loss_from, loss_to, dfs_start, dfs_end, ancestors
    members: DataFrame  # conv_id, depth, node: the way from root to leaf


def escape(text) -> F.Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role) -> F.Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape(text) -> F.Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def unescape_role(role) -> F.Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def formatted(conversations: DataFrame) -> DataFrame:
    """conv_id, key (of the conversation, never null), segment, size, head and loss (code points), and two halves of the segment's digest."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    key = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    rows = conversations.select("conv_id", key.alias("key"), "turn", role.alias("role"), text.alias("text"), F.length(head).alias("head"), F.concat(head, escape(text), F.lit(END)).alias("segment"))
    half = lambda k: F.conv(F.substring(F.sha2("segment", 256), k, 15), 16, 10).cast("long")
    loss = F.col("role") == "assistant"
    return rows.select("conv_id", "key", "turn", "role", "text", "segment", F.length("segment").cast("long").alias("size"),
                       F.when(loss, F.col("head").cast("long")).alias("loss_from"), F.when(loss, (F.length("segment") - len(END)).cast("long")).alias("loss_to"), half(1).alias("h0"), half(17).alias("h1"))


def times(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """a * b modulo PRIME, for values below it: products of halves of 31 bits, as 2**61 counts as 1."""
    b = np.asarray(b, np.uint64)
    low, up = K.U(2**31 - 1), K.U(31)
    a0, a1, b0, b1 = a & low, a >> up, b & low, b >> up
    mid = a1 * b0 + a0 * b1
    return reduced(a0 * b0 + ((a1 * b1) << K.U(1)) + (mid >> K.U(30)) + ((mid & K.U(2**30 - 1)) << up))


def reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    x = (x & K.U(PRIME)) + (x >> K.U(61))
    return np.where(x >= K.U(PRIME), x - K.U(PRIME), x)


def minus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return reduced(a + (K.U(PRIME) - b))


def sums(x: np.ndarray) -> np.ndarray:
    """Running sums modulo PRIME, from 0; halves are summed, so nothing overflows below 2**31 rows."""
    low, high = (np.concatenate([np.zeros(1, np.uint64), np.cumsum(part)]) for part in (x & K.U(2**31 - 1), x >> K.U(31)))
    return reduced(reduced(low) + times(reduced(high), 2**31))


def power(base: int, n: np.ndarray) -> np.ndarray:
    """base ** n modulo PRIME."""
    out, square = np.ones(len(n), np.uint64), base
    for bit in range(int(n.max(initial=0)).bit_length()):
        out = np.where((n >> bit) & 1, times(out, square), out)
        square = square * square % PRIME
    return out


def begun(keys: pa.Array, last: str | None) -> np.ndarray:
    """Where another conversation begins in a run of keys."""
    codes = keys.dictionary_encode()
    at = codes.indices.to_numpy(zero_copy_only=False)
    first = np.ones(len(at), bool)
    first[1:] = at[1:] != at[:-1]
    first[:1] = keys[0].as_py() != last
    return first


def numbered(rows: DataFrame) -> DataFrame:
    """rows in the order of key, turn, role and text, with depth (from 0), pos_start, and x0, x1: each conversation's running hashes, the row's own included."""
    tagged = materialize(rows.withColumn("tag", F.monotonically_increasing_id()), "segments")
    order = ["key", F.col("turn").asc_nulls_first(), "role", "text", "tag"]  # the tag only parts equal rows
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = tagged.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("turn", "role", "text", "tag")
    added = "depth long, pos_start long, x0 long, x1 long, part int"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    kept = [f.name for f in ranged.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, held = TaskContext.get().partitionId(), None, (0, 0, 0, 0)  # turns, code points and hashes so far of the last conversation
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = K.column(batch, "key")
            first = begun(keys, last)
            start = np.maximum.accumulate(np.where(first, np.arange(len(first)), -1))
            goes_on = start < 0
            depth = np.arange(len(first)) - np.where(goes_on, -held[0], start)
            size = K.column(batch, "size").to_numpy()
            ends = np.cumsum(size) - np.where(goes_on, -held[1], (np.cumsum(size) - size)[start])
            hashes = []
            for j in (0, 1):
                upto = sums(times(K.column(batch, f"h{j}").to_numpy().view(np.uint64), power(BASES[j], depth)))
                hashes.append(minus(upto[1:], np.where(goes_on, K.U(PRIME - held[2 + j]), upto[start])))
            last, held = keys[-1].as_py(), (int(depth[-1]) + 1, int(ends[-1]), int(hashes[0][-1]), int(hashes[1][-1]))
            new = [depth, ends - size, *(x.view(np.int64) for x in hashes), np.full(len(first), part, np.int32)]
            yield pa.RecordBatch.from_arrays([*(K.column(batch, c) for c in kept), *map(pa.array, new)], [*kept, "depth", "pos_start", "x0", "x1", "part"])

    local = materialize(ranged.mapInArrow(run, f"{schema}, {added}"), "numbered")
    state = F.struct((F.col("depth") + 1).alias("n"), (F.col("pos_start") + F.col("size")).alias("at"), "x0", "x1")
    ends = local.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.max_by(state, F.struct("key", "depth")).alias("s")).orderBy("part").collect()  # a row for each partition
    before, key, so_far = {}, None, (0, 0, 0, 0)
    for r in ends:
        if r["first"] == key:
            before[r["part"]] = (key, so_far)
        if r["last"] != key or r["first"] != r["last"]:
            so_far = (0, 0, 0, 0)
        n, at, x0, x1 = so_far
        s, move = r["s"], [pow(b, n, PRIME) for b in BASES]
        key, so_far = r["last"], (n + s["n"], at + s["at"], (x0 + move[0] * s["x0"]) % PRIME, (x1 + move[1] * s["x1"]) % PRIME)
    if not before:
        return local

    def move_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, parts_ = K.column(batch, "key"), K.column(batch, "part").to_numpy()
            new = {c: K.column(batch, c).to_numpy().copy() for c in ("depth", "pos_start", "x0", "x1")}
            for part in np.unique(parts_):
                if int(part) in before:
                    key, (n, at, *xs) = before[int(part)]
                    here = (parts_ == part) & np.array([x == key for x in keys.to_pylist()])
                    new["depth"][here] += n
                    new["pos_start"][here] += at
                    for j in (0, 1):
                        moved = reduced(times(new[f"x{j}"][here].view(np.uint64), pow(BASES[j], n, PRIME)) + K.U(xs[j]))
                        new[f"x{j}"][here] = moved.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(new[c]) if c in new else K.column(batch, c) for c in batch.schema.names], batch.schema.names)

    return local.mapInArrow(move_on, local.schema)


def named(rows: DataFrame) -> DataFrame:
    """conv_id, key, depth, node, parent ('' at a root), segment, size, pos_start, loss_from, loss_to: a row for each turn."""
    name = lambda x0, x1: F.lower(F.concat(F.lpad(F.hex(x0), 16, "0"), F.lpad(F.hex(x1), 16, "0")))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            depth = K.column(batch, "depth").to_numpy()
            x, h = ([K.column(batch, f"{c}{j}").to_numpy().view(np.uint64) for j in (0, 1)] for c in "xh")
            up = [minus(x[j], times(h[j], power(BASES[j], depth))) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.view(np.int64)) for x in up)], [*batch.schema.names, "u0", "u1"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = rows.mapInArrow(own, f"{schema}, u0 long, u1 long")
    parent = F.when(F.col("depth") == 0, "").otherwise(name("u0", "u1"))
    return out.select("conv_id", "key", F.col("depth").cast("int").alias("depth"), name("x0", "x1").alias("node"), parent.alias("parent"), "segment", "size", "pos_start", "loss_from", "loss_to")


def build(conversations: DataFrame) -> Forest:
    rows = materialize(named(numbered(formatted(conversations))), "turns")
    shared = ["parent", "depth", "segment", "size", "pos_start", "loss_from", "loss_to"]
    nodes = rows.groupBy("node").agg(*[F.first(c).alias(c) for c in shared], F.min("key").alias("key"), F.count("*").alias("n"))
    nodes = materialize(nodes, "nodes")  # key: a conversation that goes through the node, n: how many do
    heavy = nodes.groupBy("parent").agg(F.max_by("node", F.struct("n", "node")).alias("node"))
    light = materialize(nodes.select("node", "n").join(heavy.select("node"), "node", "left_anti"), "light")
    total = rows.count()
    exits = lookup(rows.select("key", "depth", "node"), light, "node", total)
    exits = exits.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("exits"))  # log2(conversations) at most
    asked = materialize(nodes.groupBy("key").agg(F.count("*").alias("nodes")).join(exits, "key", "left"), "exits")
    ids = nodes.select("node", "key", "depth", "size")
    own = F.filter(F.coalesce("exits", F.array().cast("array<struct<depth:int,node:string>>")), lambda x: x["depth"] <= F.col("depth"))
    ids = lookup(ids, asked, "key", ids.count(), "nodes").select("node", "key", "depth", "size", own.alias("exits"))
    deep = lambda n: F.lpad(F.hex(n), 8, "0")
    place = F.concat(F.array_join(F.transform("exits", lambda x: F.concat(F.lit("1"), deep(F.lit(2**31) - x["depth"]), x["node"])), ""), F.lit("0"), deep(F.col("depth")))
    order = running_totals(ids.withColumn("place", place), ["place"], ["size"], "dfs")
    order = materialize(order.select("node", "key", "depth", "exits", F.col("before_size").alias("dfs_start"), (F.col("before_size") + F.col("size")).alias("dfs_end")), "order")
    out = nodes.select("node", "parent", "depth", "segment", "pos_start", "loss_from", "loss_to").join(order.select("node", "dfs_start", "dfs_end"), "node")
    return Forest(out.join(ancestors(order, nodes), "node"), rows.select("conv_id", "depth", "node"))


def ancestors(order: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, ancestors: for each heavy path above, from its top to where it is left, and the node's own path down to it."""
    tops = order.select("node", "key", "depth", "dfs_start", F.posexplode("exits").alias("_i", "_x"))
    tops = tops.filter(F.col("_x.node") == F.col("node")).select("node", "dfs_start")  # the light nodes
    ends = order.select(F.col("node").alias("parent"), F.col("dfs_end").alias("left_at"))
    crowd = nodes.groupBy("parent").agg(F.count("*").alias("n"))
    ends = materialize(ends.join(crowd, "parent"), "ends")
    lit = nodes.select("node", "parent").join(tops, "node")
    lit = materialize(lit, "tops")
    met = lookup(lit.filter("parent <> ''"), ends, "parent", nodes.count()).select("node", "dfs_start", "left_at").unionByName(lit.filter("parent = ''").select("node", "dfs_start", F.lit(None).cast("long").alias("left_at")))
    used = order.select(F.col("node").alias("_of"), "dfs_start", F.explode("exits").alias("x")).select("_of", F.col("x.depth").alias("depth"), F.col("x.node").alias("node"))
    used = materialize(used, "used")
    met = materialize(met.join(used.groupBy("node").agg(F.count("*").alias("n")), "node"), "met")
    each = lookup(used, met, "node", used.count()).groupBy("_of").agg(F.array_sort(F.collect_list(F.struct("depth", "dfs_start", "left_at"))).alias("e"))
    both = order.select("node", "dfs_start").join(each.withColumnRenamed("_of", "node"), "node", "left")
    e, zero = F.coalesce("e", F.array().cast("array<struct<depth:int,dfs_start:bigint,left_at:bigint>>")), F.lit(0).cast("long")
    start = lambda x: x["dfs_start"]
    tops_of = F.concat(F.array(zero), F.transform(e, start))
    stops = F.concat(F.transform(e, lambda x: x["left_at"]), F.array(F.col("dfs_start")))
    spans = F.zip_with(tops_of, stops, lambda a, b: F.struct(a.alias("dfs_start"), b.alias("dfs_end")))
    return both.select("node", F.filter(spans, lambda s: s["dfs_end"] > s["dfs_start"]).cast(SPAN).alias("ancestors"))


def read_back(forest: Forest) -> DataFrame:
    """conv_id, depth, role, text, loss (null outside the mask), size: a row for each turn, taken from the emitted segments."""
    seg = F.col("segment")
    parsed = forest.nodes.select(
        "node", unescape_role(F.regexp_extract(seg, SEGMENT, 1)).alias("role"), unescape(F.regexp_extract(seg, SEGMENT, 2)).alias("text"),
        unescape(F.expr("substring(segment, cast(loss_from + 1 AS int), cast(loss_to - loss_from AS int))")).alias("loss"), F.length(seg).cast("long").alias("size"),
    )
    members = materialize(forest.members, "members")
    parsed = materialize(parsed.join(members.groupBy("node").agg(F.count("*").alias("n")), "node"), "parsed")
    return lookup(members, parsed, "node", members.count()).drop("n", "node")


def digests(turns: DataFrame) -> DataFrame:
    """turns: rows of `read_back`. conv_id, n_turns, turns_sha256 (of role, newline, text, newline for each turn), loss_chars, loss_sha256, formatted_chars.
    Each conversation's turns pass by in order; only the state of its digests is held."""
    key = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    rows = turns.withColumn("key", key).repartition("key").sortWithinPartitions("key", "depth")
    kind = dict(turns.dtypes)["conv_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        key, now = None, None
        for pdf in batches:
            done = []
            for k, conv, role, text, loss, size in zip(pdf["key"], pdf["conv_id"], pdf["role"], pdf["text"], pdf["loss"], pdf["size"]):
                if k != key:
                    done += [now] if now else []
                    key, now = k, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                now[1], now[5] = now[1] + 1, now[5] + size
                now[2].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    now[3] += len(loss)
                    now[4].update(loss.encode())
            yield frame(done, pdf["conv_id"].dtype)
        yield frame([now] if now else [], None)

    def frame(done: list, dtype) -> pd.DataFrame:
        rows = [(None if pd.isna(c) else c, n, a.hexdigest(), m, b.hexdigest(), size) for c, n, a, m, b, size in done]
        out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
        return out.astype({"conv_id": "Int64"} if kind in ("bigint", "int") else {})

    return rows.select("key", "conv_id", "role", "text", "loss", "size").mapInPandas(run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
