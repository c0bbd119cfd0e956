"""SentencePiece encoding and decoding, with sampled segmentations without replacement.

A text's segmentations are the paths of a lattice whose edges are vocabulary pieces (bytes where a
character has none). Each piece has a Zipf probability by its rank, to the power ALPHA (smaller: flatter), so a
segmentation has a probability; sums over all ways to the end (backward sums) make it exact. The k segmentations with the
largest Gumbel-perturbed log probability are found by best-first search: a frontier entry is a set of
paths that leave an emitted path within a range of steps, its perturbed bound is a Gumbel of the
set's total probability cut off at the bound of the set that it came from; the best entry is split where the next path
leaves, and that path is completed by sampling. So the samples are distinct and in order, and the (k+1)-th bound is
the threshold from which inclusion scores follow. All random numbers are hashes of (row key, sample, place).

No piece has a space after another character, or a line break, so the lattice falls into units
(spaces and what follows up to the next); equal units of a chunk share one lattice.

Defined cases: a null or empty text has one row, sample 0, without pieces; texts with
fewer than k segmentations give all they have; equal rows give equal samples; a null doc_id is a
key of its own; a very long text is whole, its lattice held by one task; the character U+2581 is written in bytes, so it is kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, expm1, inf, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
ALPHA = 0.2
SEED = 23
STOP = 0xFF
WORD = 2**64 - 1
CHUNK = 1 << 19
NODES = 1_500_000
_built: dict[tuple, "Vocabulary"] = {}
_checked: set[bytes] = set()


@dataclass
class Model:
    """A SentencePiece model's bytes, as the driver read them."""

    proto: bytes

    @staticmethod
    def read(path: str = MODEL) -> Model:
        with open(path, "rb") as f:
            return Model(f.read())


class Vocabulary:
    """Pieces as bytes (space for U+2581), their log weights, and a hashed trie."""

    def __init__(self, proto: bytes):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor()
        p.LoadFromSerializedProto(proto)
        n = p.get_piece_size()
        self.bytes = [b""] * n
        self.byte_ids = np.full(256, p.unk_id(), np.int64)
        trie: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i in range(n):
            name = p.id_to_piece(i)
            if p.is_byte(i):
                self.bytes[i] = bytes([int(name[3:5], 16)])
                self.byte_ids[self.bytes[i][0]] = i
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                self.bytes[i] = name.replace("▁", " ").encode()
                node = 0
                for b in self.bytes[i]:
                    node = trie.setdefault((node, b), len(trie) + 1)
                ends[node] = i
        self.weights = -np.log(np.arange(n) + 2.0)
        self.weights = ALPHA * (self.weights - np.log(np.exp(self.weights).sum()))
        self.ends = np.full(len(trie) + 1, -1, np.int64)
        self.ends[list(ends)] = list(ends.values())
        bits = max(4, (4 * len(trie)).bit_length())
        self.lattices = Lattices()
        self.shift, self.mask = K.U(64 - bits), (1 << bits) - 1
        self.keys, self.next = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        for (node, b), to in trie.items():
            at = (node * 256 + b) * 0x9E3779B97F4A7C15 % 2**64 >> int(self.shift)
            while self.keys[at] >= 0:
                at = (at + 1) & self.mask
            self.keys[at], self.next[at] = node * 256 + b, to

    def move(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie's next nodes; 0 where there is none."""
        key = node * 256 + byte
        at = (key.astype(np.uint64) * K.U(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        out = np.zeros(len(key), np.int64)
        todo = np.arange(len(key))
        while len(todo):
            found = self.keys[at]
            hit = found == key[todo]
            out[todo[hit]] = self.next[at[hit]]
            more = ~hit & (found >= 0)
            todo, at = todo[more], (at[more] + 1) & self.mask
        return out


def vocabulary(proto: bytes) -> Vocabulary:
    key = (len(proto), hash(proto))
    if key not in _built:
        _built[key] = Vocabulary(proto)
    return _built[key]


@dataclass
class Units:
    """The units of a chunk's texts (each with a space in front), and the lattices of the distinct ones."""

    doc: np.ndarray
    place: np.ndarray  # byte in its text
    start: np.ndarray  # first lattice node
    cuts: np.ndarray  # units of each text
    raw: np.ndarray  # bytes by lattice node, STOP at ends
    first: np.ndarray  # edges of each node, longest first
    end: np.ndarray
    piece: np.ndarray
    log_q: np.ndarray  # probability of an edge at its node
    upto: np.ndarray  # running sums of them within a node


def prefixed(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with a space before each text that is not empty, and the bounds of the texts."""
    size = np.diff(chunk.offsets)
    spaced = (size > 0).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(size + spaced)])
    raw = np.full(offsets[-1], 0x20, np.uint8)
    body = np.ones(len(raw), bool)
    body[offsets[:-1][spaced > 0]] = False
    raw[body] = chunk.raw
    return raw, offsets


def edges(raw: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, piece) of every piece in the units, and bytes for characters without a piece."""
    head = np.nonzero(((raw & 0xC0) != 0x80) & (raw != STOP))[0]
    ends_char = np.ones(len(raw) + 1, bool)
    ends_char[:-1] = (raw & 0xC0) != 0x80
    after = np.nonzero(ends_char)[0]
    char_end = after[np.searchsorted(after, head, "right")]
    covered = np.zeros(len(raw), bool)
    at, node, starts, stops, ids = head, np.zeros(len(head), np.int64), [], [], []
    step = 0
    goal = np.zeros(len(raw), np.int64)
    goal[head] = char_end
    while len(at):
        node = v.move(node, raw[at + step].astype(np.int64))
        alive = node > 0
        at, node = at[alive], node[alive]
        step += 1
        piece = v.ends[node]
        hit = piece >= 0
        starts.append(at[hit])
        stops.append(at[hit] + step)
        ids.append(piece[hit])
        covered[at[hit][goal[at[hit]] == at[hit] + step]] = True
    bare = head[~covered[head]]
    size = goal[bare] - bare
    each = np.repeat(bare, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.concatenate([each, *starts[::-1]]), np.concatenate([each + 1, *stops[::-1]]), np.concatenate([v.byte_ids[raw[each]], *ids[::-1]])


def lattice(raw: np.ndarray, stops: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, ...]:
    """first, end, piece, log_q, upto of the units in raw; stops: the node where each ends."""
    start, end, piece = edges(raw, v)
    order = np.argsort(start, kind="stable")  # sorted runs, longest pieces first
    start, end, piece = start[order], end[order], piece[order]
    stop_of = np.repeat(stops, np.diff(stops, prepend=-1))
    left = stop_of[start] - start
    order = np.argsort(left.astype(np.uint16) if left.max(initial=0) < 65536 else left, kind="stable")
    beta, x = np.zeros(len(raw)), v.weights[piece]
    share = np.zeros(len(x))
    sizes = np.bincount(left)
    b = 0
    for distance in np.nonzero(sizes)[0]:
        a, b = b, b + sizes[distance]
        o = order[a:b]
        s, y = start[o], x[o] + beta[end[o]]
        new = np.nonzero(np.concatenate([[True], s[1:] != s[:-1]]))[0]
        each = np.diff(np.concatenate([new, [len(o)]]))
        top = np.zeros(len(new)) if distance < 200 else np.maximum.reduceat(y, new)  # near the end no sum can vanish
        mass = np.exp(y - np.repeat(top, each))
        total = np.add.reduceat(mass, new)
        full = top + np.log(total)
        beta[s[new]] = full
        x[o] = y - np.repeat(full, each)
        share[o] = mass / np.repeat(total, each)
    first = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(raw)))])
    sums = np.concatenate([[0], np.cumsum(share)])
    upto = sums[1:] - sums[first[start]]
    return first, end, piece, np.minimum(x, 0.0), upto


class Lattices:
    """Lattices of the units met so far in this worker; forgotten when they pass NODES nodes, so memory is bounded."""

    def __init__(self) -> None:
        self.clear(NODES)

    def clear(self, nodes: int) -> None:
        self.hashes, self.starts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.nodes, self.edges = 0, 0
        self.raw, self.first = np.full(nodes, STOP, np.uint8), np.zeros(nodes + 1, np.int64)
        self.grow(int(2.2 * nodes))

    def grow(self, n: int) -> None:
        kinds = {"end": np.int32, "piece": np.int32, "log_q": np.float32, "upto": np.float32}
        for name, kind in kinds.items():
            new = np.zeros(n, kind)
            if self.edges:
                new[: self.edges] = getattr(self, name)[: self.edges]
            setattr(self, name, new)

    def place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted hashes: their first nodes, and which are known."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.starts[at], self.hashes[at] == hashes

    def add(self, raw: np.ndarray, starts: np.ndarray, size: np.ndarray, hashes: np.ndarray, v: Vocabulary) -> np.ndarray:
        """First nodes of the units at raw[starts : starts + size]; hashes are sorted and distinct."""
        node, known = self.place(hashes)
        need = int((size[~known] + 1).sum())
        if self.nodes + need > len(self.raw):
            need = int((size + 1).sum())
            self.clear(max(NODES, need))
            known[:] = False
        new = np.nonzero(~known)[0]
        if not len(new):
            return node
        size = size[new]
        begin = np.cumsum(size + 1) - (size + 1)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        own = np.full(need, STOP, np.uint8)
        own[np.repeat(begin, size) + within] = raw[np.repeat(starts[new], size) + within]
        first, end, piece, log_q, upto = lattice(own, begin + size, v)
        if self.edges + len(end) > len(self.end):
            self.grow((self.edges + len(end)) * 5 // 4)
        at = slice(self.edges, self.edges + len(end))
        self.raw[self.nodes : self.nodes + need] = own
        self.first[self.nodes : self.nodes + need + 1] = first + self.edges
        self.end[at], self.piece[at], self.log_q[at], self.upto[at] = end + self.nodes, piece, log_q, upto
        node[new] = begin + self.nodes
        everything = np.concatenate([self.hashes, hashes[new]])
        order = np.argsort(everything, kind="stable")
        self.hashes, self.starts = everything[order], np.concatenate([self.starts, node[new]])[order]
        self.nodes += need
        self.edges += len(end)
        return node


def units(chunk: K.Chunk, v: Vocabulary) -> Units:
    raw, offsets = prefixed(chunk)
    space, line = raw == 0x20, raw == 0x0A
    begin = np.zeros(len(raw) + 1, bool)
    begin[:-1] = line | space
    begin[1:-1] &= ~(space[1:] & space[:-1])
    begin[1:-1] |= line[:-1]
    begin[offsets] = True
    bounds = np.nonzero(begin)[0]
    starts, ends = bounds[:-1], bounds[1:]
    node, k = shared_nodes(raw, starts, ends, v), v.lattices
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Units(doc, starts - offsets[doc], node, np.searchsorted(starts, offsets), k.raw, k.first[: k.nodes + 1], k.end, k.piece, k.log_q, k.upto)


def shared_nodes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, v: Vocabulary) -> np.ndarray:
    """The lattice of each unit. Units of equal hashes share one only where their bytes are equal, too; others are hashed anew."""
    hashes, size = K.spans_hash(raw, starts, ends), ends - starts
    unit = np.repeat(np.arange(len(size)), size)
    step = np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)
    while True:
        _, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        node = v.lattices.add(raw, starts[one], size[one], hashes[one], v)[which]
        held, last = v.lattices.raw, len(v.lattices.raw) - 1
        other = held[np.minimum(node + size, last)] != STOP
        other[unit[held[np.minimum(node[unit] + step, last)] != raw[starts[unit] + step]]] = True
        if not other.any():
            return node
        hashes[other] = K.mix(hashes[other] ^ K.spans_hash(raw, starts[other], ends[other], 1))


def numbers(key: np.ndarray, salt: int, place: np.ndarray | int) -> np.ndarray:
    """Uniform in (0, 1), from (key, salt, place)."""
    x = K.mix(key + K.U(salt * 0x9E3779B97F4A7C15 % 2**64) + np.asarray(place).astype(np.uint64) * K.U(0xD1B54A32D192ED03))
    return ((x >> K.U(11)).astype(float) + 0.5) / 2.0**53


def walk(u: Units, which: np.ndarray, node: np.ndarray, key: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Completes the paths of units `which` from `node`: the edges in order, and where each unit's begin."""
    steps, at, cur, origin = [], np.arange(len(which)), node, u.start[which]
    place, mine = u.place[which], key[u.doc[which]]
    while True:
        go = u.raw[cur] != STOP
        at, cur = at[go], cur[go]
        if not len(at):
            break
        x = numbers(mine[at], salt, place[at] + cur - origin[at])
        e, last = u.first[cur], u.first[cur + 1] - 1
        todo = np.nonzero((x >= u.upto[e]) & (e < last))[0]
        while len(todo):
            e[todo] += 1
            todo = todo[(x[todo] >= u.upto[e[todo]]) & (e[todo] < last[todo])]
        steps.append((at, e))
        cur = u.end[e]
    counts = np.zeros(len(which), np.int64)
    for a, _ in steps:
        counts[a] += 1
    begins = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(begins[-1], np.int64)
    for j, (a, e) in enumerate(steps):
        out[begins[a] + j] = e
    return out, begins


def cut_gumbel(log_mass: float, bound: float, u: float) -> float:
    """A Gumbel number of this log mass, given that it is at most bound."""
    free = log_mass - log(-log(u))
    top = max(-bound, -free)
    return -(top + log(exp(-bound - top) + exp(-free - top)))


def log_rest(x: float) -> float:
    """log(1 - exp(x)) for x <= 0."""
    return -inf if x >= 0 else log(-expm1(x)) if x > -0.6931 else log1p(-exp(x))


class Search:
    """The frontier of one text: perturbed best-first search over sets of paths."""

    def __init__(self, key: int):
        self.key, self.draws, self.paths, self.sums, self.found, self.frontier = key, 0, [], [], [], []

    def draw(self) -> float:
        self.draws += 1
        x = (self.key + 1_000_003 * 0x9E3779B97F4A7C15 + self.draws * 0xD1B54A32D192ED03) & WORD
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ x >> shift) * by & WORD
        return ((x ^ x >> 31) >> 11) / 2.0**53 + 2.0**-54

    def push(self, log_mass: float, bound: float, entry: tuple) -> None:
        if log_mass > -inf:
            heapq.heappush(self.frontier, (-cut_gumbel(log_mass, bound, self.draw()), self.draws, entry))

    def ranged(self, j: int, a: int, b: int, bound: float) -> None:
        """The paths that leave path j at one of the steps a..b-1."""
        if a < b:
            s = self.sums[j]
            self.push(float(s[a]) + log_rest(float(s[b] - s[a])), bound, (j, a, b, None))

    def emit(self, path: np.ndarray, log_q: np.ndarray, bound: float, since: int) -> None:
        self.paths.append(path)
        self.sums.append(np.concatenate([[0.0], np.cumsum(log_q, dtype=float)]))
        self.found.append(bound)
        self.ranged(len(self.paths) - 1, since, len(path), bound)

    def split(self, u: Units) -> tuple[int, int, int, float] | None:
        """Pops the best set: its next path leaves path j at step i by edge e."""
        if not self.frontier:
            return None
        bound, _, (j, a, b, used) = heapq.heappop(self.frontier)
        bound = -bound
        s = self.sums[j]
        if used is None:
            goal = log1p(self.draw() * expm1(float(s[b] - s[a])))
            i = min(a + int(np.searchsorted(-(s[a + 1 : b + 1] - s[a]), -goal)), b - 1)
            while s[i + 1] == s[i] and i > a:  # a step without another edge
                i -= 1
            self.ranged(j, a, i, bound)
            self.ranged(j, i + 1, b, bound)
            used = (int(self.paths[j][i]),)
        else:
            i = a
        n = int(np.searchsorted(u.first, used[0], "right")) - 1
        rest = [e for e in range(int(u.first[n]), int(u.first[n + 1])) if e not in used]
        q = np.exp(u.log_q[rest])
        e = rest[min(int(np.searchsorted(np.cumsum(q), self.draw() * q.sum())), len(rest) - 1)]
        left = float(q.sum() - np.exp(u.log_q[e]))
        if len(rest) > 1 and left > 0:
            self.push(float(s[i]) + log(left), bound, (j, i, i + 1, (*used, e)))
        return j, i, e, bound


def search(u: Units, keys: np.ndarray, k: int) -> list[Search]:
    """The k best perturbed segmentations of each text of the chunk; round by round, all texts together."""
    n_docs = len(u.cuts) - 1
    out, begins = walk(u, np.arange(len(u.doc)), u.start, keys, 1)
    found = [Search(x) for x in keys.tolist()]
    for d, s in enumerate(found):
        a, b = begins[u.cuts[d]], begins[u.cuts[d + 1]]
        if a < b:
            s.emit(out[a:b], u.log_q[out[a:b]], -log(-log(s.draw())), 0)
    for sample in range(2, k + 1):
        todo, which, nodes = [], [], []
        for d, s in enumerate(found):
            if len(s.paths) != sample - 1 or (got := s.split(u)) is None:
                continue
            j, i, e, bound = got
            # the unit in which step i lies: lengths of the pieces up to it
            size = int((u.end[s.paths[j][:i]] - start_of(u, s.paths[j][:i])).sum())
            places = u.place[u.cuts[d] : u.cuts[d + 1]]
            unit = int(np.searchsorted(places, size, "right")) - 1 + int(u.cuts[d])
            which.append(np.arange(unit, u.cuts[d + 1]))
            first = u.start[unit : u.cuts[d + 1]].copy()
            first[0] = u.end[e]
            nodes.append(first)
            todo.append((d, j, i, e, bound, len(first)))
        if not todo:
            break
        more, begins = walk(u, np.concatenate(which), np.concatenate(nodes), keys, sample)
        at = 0
        for d, j, i, e, bound, n in todo:
            s = found[d]
            path = np.concatenate([s.paths[j][:i], [e], more[begins[at] : begins[at + n]]])
            s.emit(path, u.log_q[path], bound, i + 1)
            at += n
    return found


def start_of(u: Units, e: np.ndarray) -> np.ndarray:
    return np.searchsorted(u.first, e, "right") - 1


SCHEMA = "sample int, n_pieces int, log_prob double, perturbed double, threshold double, log_inclusion double, ids array<int>"


def check_units(model: Model) -> None:
    """An error if a piece of the model would lie across the units: a space after another character, or a line break with others."""
    import sentencepiece

    if model.proto in _checked:
        return
    p = sentencepiece.SentencePieceProcessor()
    p.LoadFromSerializedProto(model.proto)
    for i in range(p.get_piece_size()):
        piece = p.id_to_piece(i)
        if not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i) or p.is_byte(i)) and ("▁" in piece.lstrip("▁") or ("\n" in piece and piece != "\n")):
            raise ValueError(f"the piece {piece!r} has a space or line break inside; texts are cut there")
    _checked.add(model.proto)


def sample(docs: DataFrame, k: int = SAMPLES, model: Model | None = None, seed: int = SEED, copy: str | None = None) -> DataFrame:
    """doc_id and SCHEMA: up to k rows for each row of docs, best first. copy: an integer column that is part of the row key and comes after doc_id.

    threshold: the (k+1)-th perturbed bound (null if there is none); log_inclusion: the log of the chance
    that a segmentation of this probability exceeds it (0 without one).
    """
    proto = docs.sparkSession.sparkContext.broadcast((model or Model.read()).proto)  # a vocabulary file
    check_units(model or Model.read())
    own = ["doc_id"] + ([copy] if copy else [])
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *([F.col(copy).cast("long")] if copy else []))
    keyed = docs.select(*own, "text", key.alias("key"))
    kinds_of = ", ".join(f"`{c}` {t}" for c, t in keyed.dtypes if c in own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(proto.value)
        for batch in batches:
            keys = K.column(batch, "key").to_numpy().view(np.uint64)
            ids = [K.column(batch, x) for x in own]
            for c in K.chunks(K.column(batch, "text"), CHUNK):
                u = units(c, v)
                found = search(u, keys[c.first : c.first + c.n], k)
                at, rows, paths = [], [], []
                for d, s in enumerate(found):
                    least = -s.frontier[0][0] if s.frontier and len(s.paths) == k else None
                    if not s.paths:
                        at.append(c.first + d)
                        rows.append((0, 0, 0.0, None, None, 0.0))
                        paths.append(np.zeros(0, np.int64))
                    for j, path in enumerate(s.paths):
                        p = float(s.sums[j][-1])
                        x = 0.0 if least is None else p - least
                        inc = 0.0 if least is None else log(-expm1(-exp(x))) if x > -30 else x
                        at.append(c.first + d)
                        rows.append((j + 1, len(path), p, s.found[j], least, inc))
                        paths.append(path)
                lists = K.list_array(pa.array(u.piece[np.concatenate(paths)].astype(np.int32)), np.concatenate([[0], np.cumsum([len(x) for x in paths])]))
                columns = list(zip(*rows))
                kinds = [pa.int32(), pa.int32(), *[pa.float64()] * 4]
                yield pa.RecordBatch.from_arrays([*(x.take(pa.array(at)) for x in ids), *(pa.array(x, t) for x, t in zip(columns, kinds)), lists], [*own, "sample", "n_pieces", "log_prob", "perturbed", "threshold", "log_inclusion", "ids"])
        K.release()

    return keyed.mapInArrow(run, f"{kinds_of}, {SCHEMA}")


def encode(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, ids: the model's own best segmentation of each text; null counts as empty."""
    kind = dict(docs.dtypes)["doc_id"]
    proto = docs.sparkSession.sparkContext.broadcast((model or Model.read()).proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(proto.value)
        for batch in batches:
            ids = v.processor.encode([x or "" for x in batch.column(1).to_pylist()], num_threads=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, model: Model | None = None, ids_col: str = "ids") -> DataFrame:
    """encoded's columns and text: the bytes of the pieces in order, without the space in front; null ids give null. A column text is replaced."""
    encoded = encoded.drop("text")
    proto = encoded.sparkSession.sparkContext.broadcast((model or Model.read()).proto)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields) + ", text string"

    def text(ids, table) -> str | None:
        if ids is None:
            return None
        return b"".join(table[i] for i in ids)[1:].decode("utf-8", "replace") if ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = vocabulary(proto.value).bytes
        for batch in batches:
            texts = pa.array([text(x, table) for x in K.column(batch, ids_col).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "text"])

    return encoded.mapInArrow(run, schema)
