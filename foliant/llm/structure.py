"""Conversation structure repair by a dynamic program over macro edits with rank-compressed audit strings.

A conversation should read, by the initials of its roles, as `(s?(ua)+)?`. Its rows are kept (K), given the role user or assistant (R),
deleted (D), and empty turns inserted (I); of the cheapest edits the one with the least audit string wins. A macro edit is a run of
inserts and the edit of one row; the audit strings of macro edits are prefix-free, so they are ordered codes, and two ways through the same rows compare
as their codes do. A layer (one row) has a state for each of the four places in the grammar, with its least cost; instead of audit
strings it keeps the rank of each state's string among the layer's, and each state points to its parent and code. Strings are written
once, from the pointers.

Ranks make layers small: a layer depends on the one before and on what kind of row comes, and as states too far behind are left out,
few different ones exist, so each is worked out once in a worker and then looked up. They also compose: a run of rows is a table from the state before it to cost and rank after it. So rows are
range-partitioned by conversation and turn, however long a conversation is; each partition solves its own rows, a conversation cut by partitions from
every state it may begin in, and the cuts (one a partition) are put together on the driver. What is left for one task of one conversation is to hash its rows in
their order, which SHA-256 asks for, without holding them.

Defined cases: null roles and texts are one space, as are null ids and turns in the key that damages are drawn by; a null conv_id is a
conversation; rows go by turn (nulls first), role and text as they are after damage; a row without a role has no initial, so it may stay anywhere; equal rows are duplicates; a
very long text is whole, one row of one task; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import discard, lookup, materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
EMPTY, S, U, A = range(4)  # nothing yet; after s, u and a
STEP = {(EMPTY, "s"): S, (EMPTY, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
ENDS = {EMPTY: 0, S: 2, U: 1, A: 0}  # inserts that complete a conversation
MACROS = sorted("I" * n + edit for n in range(3) for edit in "DKR")  # no longer run of inserts is ever cheapest: two of them lead back to the same place
CODE = {m: i for i, m in enumerate(MACROS)}
NONE, HEAD, GONE, ROW = 10**9, 0, 1, 2
BEHIND = 12  # whatever follows, a state can be imitated from another one for less: two inserts (6) and one deletion (4)
FAULTS = ["", "blank", "duplicate", "truncated"]
ROLES = {"u": "user", "a": "assistant"}
_moves: dict[tuple, tuple] = {}
_layers: dict[tuple, tuple] = {}


def plain(conversations: DataFrame) -> DataFrame:
    """conv_id, key (never null), turn, role, text: null roles and texts are one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.coalesce(F.concat(F.lit("v"), F.col("conv_id").cast("string")), F.lit("n"))
    return conversations.select("conv_id", key.alias("key"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))


def damaged(rows: DataFrame) -> DataFrame:
    """rows of `plain` after damage, with gone: a dropped row stays, marked, so that no conversation is lost."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    drawn = rows.withColumn("draw", F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))), F.lit(20)))
    role = F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role"))
    text = F.when(F.col("draw") < 2, F.lit("")).when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("draw") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return drawn.select("conv_id", "key", "turn", role.alias("role"), text.alias("text"), (F.col("draw") == 0).alias("gone"), copies.alias("copy")).drop("copy")


def faults(rows: DataFrame) -> DataFrame:
    """rows with tag and fault, a place in FAULTS. Equal rows of a conversation meet in counts and least places, not in one task."""
    same = F.unhex(F.sha2(F.concat_ws("\n", "key", F.length("role"), "role", "text"), 256))
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    rows = materialize(rows.select("conv_id", "key", "turn", "role", "text", gone.alias("gone"), F.when(~gone, same).alias("same"), F.monotonically_increasing_id().alias("tag")), "damaged")
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn", "tag")
    firsts = materialize(rows.filter(~F.col("gone")).groupBy("same").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1"), "firsts")
    end = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    alone = F.when(end == "", 1).when(~end.isin(".", "!", "?"), 3).otherwise(0)
    more = F.when(end == "", 1).when(F.col("first.tag") != F.col("tag"), 2).otherwise(alone)
    columns = ["conv_id", "key", "turn", "role", "text", "gone", "tag"]
    if firsts.isEmpty():
        return rows.select(*columns, alone.alias("fault"))
    total = rows.count()
    twice = lookup(rows.filter(~F.col("gone")), firsts, "same", total).select(*columns, more.alias("fault"))
    hot = F.broadcast(firsts.filter(F.col("n") * 1000 > total).select("same"))  # 1,000 rows at most
    once = rows.filter(~F.col("gone")).join(hot, "same", "left_anti").join(firsts.select("same"), "same", "left_anti")
    return twice.unionByName(once.select(*columns, alone.alias("fault"))).unionByName(rows.filter("gone").select(*columns, F.lit(0).alias("fault")))


def moves(kind: tuple[str, int]) -> tuple[tuple[int, int, int, int], ...]:
    """kind: initial and fault of a row. (from, code, to, cost) of its macro edits."""
    if kind not in _moves:
        initial, fault = kind
        out = []
        for state, macro in itertools.product(range(4), MACROS):
            at, cost = state, 0
            for _ in macro[:-1]:
                at, cost = STEP.get((at, "u" if at in (EMPTY, S, A) else "a")), cost + INSERT
            edit = macro[-1]
            if edit == "D":
                cost += DELETE
            elif fault in (1, 2):
                continue
            else:
                new = initial if edit == "K" else "a" if at == U else "u"
                at = at if new == "" else STEP.get((at, new))
                cost += (REROLE if edit == "R" else KEEP) + (TRUNCATED if fault == 3 else 0)
            if at is not None:
                out.append((state, CODE[macro], at, cost))
        _moves[kind] = tuple(out)
    return _moves[kind]


def layer(before: tuple, kind: tuple[str, int]) -> tuple[tuple, int, int]:
    """before: cost above the least and rank of each state. The next layer, the least cost in it, and its pointers: four of 6 bits, code * 4 + parent.

    Equal strings would be equal states, so ranks of a layer differ.
    """
    found = _layers.get((before, kind))
    if found is None:
        best: dict[int, tuple[int, int, int, int]] = {}
        for state, code, to, cost in moves(kind):
            if before[state][0] < NONE:
                way = (before[state][0] + cost, before[state][1], code, state)
                if to not in best or way < best[to]:
                    best[to] = way
        least = min(way[0] for way in best.values())
        best = {to: way for to, way in best.items() if way[0] <= least + BEHIND}
        rank = {to: r for r, to in enumerate(sorted(best, key=lambda to: best[to][1:3]))}
        after = tuple((best[to][0] - least, rank[to]) if to in best else (NONE, 0) for to in range(4))
        cells = sum((best[to][2] * 4 + best[to][3]) << 6 * to for to in best)
        found = _layers[before, kind] = (after, least, cells)
    return found


def begin(state: int) -> tuple:
    return tuple((0, 0) if s == state else (NONE, 0) for s in range(4))


class Run:
    """Rows of one conversation that follow each other in a partition, from each state in `starts`."""

    def __init__(self, starts: tuple[int, ...]) -> None:
        self.starts = starts
        self.at = [(begin(s), 0) for s in starts]
        self.cells: list[list[int]] = [[] for _ in starts]

    def add(self, kind: tuple[str, int]) -> None:
        for j, (now, cost) in enumerate(self.at):
            after, least, cells = layer(now, kind)
            self.at[j] = (after, cost + least)
            self.cells[j].append(cells)

    def table(self) -> list[list[int]]:
        """For each start: cost and rank of the four ends, NONE where there is no way."""
        return [[x for c, r in now for x in ((cost + c if c < NONE else NONE), r)] for now, cost in self.at]


def way(cells: bytes, end: int) -> tuple[bytes, int]:
    """The codes of a run's macro edits, in order, and the state it began in, from its pointers."""
    pointers = struct.unpack(f"<{len(cells) // 4}I", cells)
    codes, state = bytearray(len(pointers)), end
    for i in range(len(pointers) - 1, -1, -1):
        cell = pointers[i] >> 6 * state & 63
        codes[i], state = cell >> 2, cell & 3
    return bytes(codes), state


def last(costs: list[int]) -> tuple[int, int]:
    """(end state, cost with its last inserts) of costs and ranks: the cheapest, then the least string."""
    ways = [(costs[2 * s] + INSERT * ENDS[s], costs[2 * s + 1], ENDS[s], s) for s in range(4) if costs[2 * s] < NONE]
    cost, _, _, state = min(ways)
    return state, cost


def solved(rows: DataFrame) -> DataFrame:
    """rows of `faults` in order, with part and i (their place), and a row of kind HEAD before each run of a conversation in a partition, with
    its length, pointers and costs for each start."""
    order = ["key", F.col("turn").asc_nulls_first(), "role", "text", "tag"]
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    kind = dict(rows.dtypes)["conv_id"]
    names = ["conv_id", "key", "part", "i", "kind", "turn", "role", "text", "fault", "cells", "ends", "cut"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, i, key, conv, now, first = TaskContext.get().partitionId(), 0, None, None, None, True

        def head(cut: bool) -> list[dict]:
            cells = [struct.pack(f"<{len(c)}I", *c) for c in now.cells]
            return [{"conv_id": conv, "key": key, "part": part, "i": -1, "kind": HEAD, "cells": cells, "ends": now.table(), "cut": cut}]

        for batch in batches:
            heads, keys = [], K.column(batch, "key").to_pylist()
            convs = K.column(batch, "conv_id")
            initials = pc.utf8_slice_codeunits(K.column(batch, "role"), 0, 1).to_pylist()
            gone, fault = K.column(batch, "gone").to_pylist(), K.column(batch, "fault").to_pylist()
            for j, k in enumerate(keys):
                if k != key:
                    if key is not None:
                        heads += head(first)
                        first = False
                    key, conv = k, convs[j].as_py()
                    now = Run((EMPTY, S, U, A) if part and first else (EMPTY,))
                if not gone[j]:
                    now.add((initials[j], fault[j]))
            n = len(keys)
            own = {"part": np.full(n, part, np.int32), "i": np.arange(i, i + n), "kind": np.where(gone, GONE, ROW).astype(np.int32), "cells": pa.nulls(n, pa.list_(pa.binary())), "ends": pa.nulls(n, pa.list_(pa.list_(pa.int64()))), "cut": pa.nulls(n, pa.bool_())}
            i += n
            yield pa.RecordBatch.from_arrays([pa.array(own[c]) if c in own and isinstance(own[c], np.ndarray) else own[c] if c in own else K.column(batch, c) for c in names], names)
            if heads:
                yield framed(heads)
        if key is not None:
            yield framed(head(True))
        K.release()

    types = {"part": pa.int32(), "i": pa.int64(), "kind": pa.int32(), "turn": pa.int64(), "role": pa.string(), "text": pa.string(), "key": pa.string(), "fault": pa.int32(), "cells": pa.list_(pa.binary()), "ends": pa.list_(pa.list_(pa.int64())), "cut": pa.bool_()}
    types["conv_id"] = pa.int64() if kind in ("bigint", "int") else pa.string()

    def framed(heads: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h.get(c) for h in heads], types[c]) for c in names], names)

    return ranged.mapInArrow(run, f"conv_id {kind}, key string, part int, i long, kind int, turn long, role string, text string, fault int, cells array<binary>, ends array<array<long>>, cut boolean")


def bridged(heads: list) -> dict[tuple[str, int], tuple[int, int, int]]:
    """heads: key, part and ends of the runs at the borders of partitions, two a partition. For those of conversations in several
    partitions: the place of its start in the run's table, its end, and the whole cost at the conversation's last run (0 before)."""
    out = {}
    for _, group in itertools.groupby(sorted(heads, key=lambda h: (h["key"], h["part"])), key=lambda h: h["key"]):
        runs = list(group)
        at, pointers = [0, 0] + [NONE, 0] * 3, []
        for h in runs:
            best: dict[int, tuple] = {}
            for j, state in enumerate(range(4) if len(h["ends"]) == 4 else (EMPTY,)):
                for end in range(4):
                    if at[2 * state] < NONE and h["ends"][j][2 * end] < NONE:
                        step = (at[2 * state] + h["ends"][j][2 * end], at[2 * state + 1], h["ends"][j][2 * end + 1], state)
                        if end not in best or step < best[end]:
                            best[end] = step
            rank = {end: r for r, end in enumerate(sorted(best, key=lambda end: best[end][1:3]))}
            at = [x for end in range(4) for x in ((best[end][0], rank[end]) if end in best else (NONE, 0))]
            pointers.append({end: step[3] for end, step in best.items()})
        end, cost = last(at)
        for n, h in reversed(list(enumerate(runs))):
            start = pointers[n][end]
            out[h["key"], h["part"]] = (start if len(h["ends"]) == 4 else 0, end, cost if n == len(runs) - 1 else 0)
            end = start
    return out


def told(rows: DataFrame) -> DataFrame:
    """rows of `solved`, written. One row for each conversation."""
    kind = dict(rows.dtypes)["conv_id"]
    heads = rows.filter("cut").select("key", "part", "ends").collect()  # two rows a partition at most
    often = {k for k, g in itertools.groupby(sorted(h["key"] for h in heads)) if len(list(g)) > 1}
    ways = bridged([h.asDict() for h in heads if h["key"] in often])
    dealt = rows.repartition("key").sortWithinPartitions("key", "part", "i")
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256", "n_rows", "n_repaired"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, ids = None, None, pa.null()

        def frame(done: list[Story]) -> pa.RecordBatch:
            columns = [pa.array(c, pa.string() if name in ("audit", "repaired_sha256") else pa.int64()) for name, c in zip(names, zip(*(s.close() for s in done)) if done else [[]] * len(names))]
            return pa.RecordBatch.from_arrays([pa.array([s.conv_id for s in done], ids), *columns], ["conv_id", *names])

        for batch in batches:
            done, ids = [], K.column(batch, "conv_id").type
            for row_key, conv, *row in zip(*(K.column(batch, c).to_pylist() for c in ("key", "conv_id", "part", "kind", "turn", "role", "text", "fault", "cells", "ends"))):
                if row_key != key:
                    done += [now] if now else []
                    key, now = row_key, Story(conv)
                now.take(*row, ways.get((key, row[0])))
            if done:
                yield frame(done)
        if now:
            yield frame([now])
        K.release()

    columns = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string, n_rows long, n_repaired long"
    return dealt.select("key", "part", "kind", "turn", "role", "text", "fault", "cells", "ends", "conv_id").mapInArrow(run, f"conv_id {kind}, {columns}")


class Story:
    """One conversation, row by row: counts, and the digest of what repair makes of it. Of its rows nothing is held but the codes of one run."""

    def __init__(self, conv_id) -> None:
        self.conv_id, self.sha, self.out, self.audit = conv_id, hashlib.sha256(), 0, []
        self.turns, self.low, self.high, self.seen, self.before = 0, None, None, None, None
        self.faults, self.illegal, self.cost, self.rows = [0, 0, 0, 0], 0, 0, 0
        self.state, self.codes, self.at = EMPTY, b"", 0

    def take(self, part, kind, turn, role, text, fault, cells, ends, bridge) -> None:
        if kind == HEAD:
            start, end, cost = bridge if bridge else (0, *last(list(ends[0])))
            self.codes, _ = way(cells[start], end)
            self.at, self.cost = 0, self.cost + cost
        elif kind == ROW:
            self.rows += 1
            self.faults[fault] += 1
            if turn is not None:
                self.turns += turn != self.seen
                self.low, self.high, self.seen = turn if self.low is None else self.low, turn, turn
            if self.before is not None and self.before + role[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = role[:1]
            macro = MACROS[self.codes[self.at]]
            self.at += 1
            for _ in macro[:-1]:
                self.insert()
            if macro[-1] == "K":
                self.emit(role, text)
            elif macro[-1] == "R":
                self.emit(ROLES["a" if self.state == U else "u"], text)
            self.audit.append(macro)

    def insert(self) -> None:
        self.emit(ROLES["a" if self.state == U else "u"], "")

    def emit(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.out else ''}{role}:{text}".encode())
        self.out += 1
        self.state = self.state if role == "" else STEP[self.state, role[0]]

    def close(self) -> tuple:
        for _ in range(ENDS[self.state]):
            self.insert()
            self.audit.append("I")
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.sha.hexdigest(), self.rows, self.out)


def repair(rows: DataFrame) -> DataFrame:
    """rows: `plain` or `damaged`. conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, n_rows, n_repaired: a row for each conversation."""
    found = materialize(faults(rows), "faults")
    places = materialize(solved(found), "solved")
    discard(found)
    return told(places)


def oracle() -> str:
    """Audit strings and texts themselves, layer by layer."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(s) + 1), lambda i: [CAST(ascii(s[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))), "
           "lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)")
    def word(c):
        return rf"regexp_matches({c}, '[^\x20\x09-\x0D]')"
    steps = ", ".join(f"({a}, '{x}', {b})" for (a, x), b in STEP.items())
    return rf"""
WITH RECURSIVE raw AS (SELECT conv_id, coalesce('v' || CAST(conv_id AS VARCHAR), 'n') AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
drawn AS (SELECT *, {crc} % 20 AS d FROM raw),
rows_ AS (SELECT conv_id, key, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role, CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM drawn, unnest(CASE WHEN d = 3 THEN [0, 1] WHEN d = 0 THEN [] ELSE [0] END) AS c(copy)),
placed AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, text) AS i FROM rows_),
faulty AS (SELECT *, left(role, 1) AS x, row_number() OVER (PARTITION BY key, role, text ORDER BY i) > 1 AS again, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM placed),
r AS (SELECT *, CASE WHEN NOT {word("text")} THEN 1 WHEN again THEN 2 WHEN NOT regexp_matches(tail, '^[.!?]$') THEN 3 ELSE 0 END AS f FROM faulty),
step(a, x, b) AS (VALUES {steps}),
runs(a, n, b, ins) AS (VALUES (0, 0, 0, ''), (1, 0, 1, ''), (2, 0, 2, ''), (3, 0, 3, ''), (0, 1, 2, chr(10) || 'user:'), (1, 1, 2, chr(10) || 'user:'), (2, 1, 3, chr(10) || 'assistant:'), (3, 1, 2, chr(10) || 'user:'),
    (0, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 2, 2, chr(10) || 'assistant:' || chr(10) || 'user:'), (3, 2, 3, chr(10) || 'user:' || chr(10) || 'assistant:')),
edit AS (SELECT key, i, a, b, repeat('I', n) || 'D' AS code, 3 * n + 4 AS cost, ins AS made FROM r, runs
  UNION ALL SELECT key, i, runs.a, CASE WHEN r.x = '' THEN runs.b ELSE step.b END, repeat('I', n) || 'K', 3 * n + CASE WHEN f = 3 THEN 3 ELSE 0 END, ins || chr(10) || role || ':' || text FROM r, runs LEFT JOIN step ON step.a = runs.b AND step.x = r.x WHERE f IN (0, 3) AND (r.x = '' OR step.b IS NOT NULL)
  UNION ALL SELECT key, i, runs.a, step.b, repeat('I', n) || 'R', 3 * n + 3 + CASE WHEN f = 3 THEN 3 ELSE 0 END, ins || chr(10) || CASE step.x WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text FROM r, runs JOIN step ON step.a = runs.b AND step.x <> 's' WHERE f IN (0, 3)),
dp(key, i, a, cost, audit, made) AS (
  SELECT DISTINCT key, CAST(0 AS BIGINT), 0, 0, '', '' FROM raw
  UNION ALL SELECT key, i, b, cost, audit, made FROM (
    SELECT key, i, b, cost, audit, made, row_number() OVER (PARTITION BY key, b ORDER BY cost, audit) AS k FROM (
      SELECT dp.key, edit.i, edit.b, dp.cost + edit.cost AS cost, dp.audit || edit.code AS audit, dp.made || edit.made AS made FROM dp JOIN edit ON edit.key = dp.key AND edit.i = dp.i + 1 AND edit.a = dp.a)) WHERE k = 1),
n AS (SELECT key, any_value(conv_id) AS conv_id FROM raw GROUP BY key),
m AS (SELECT key, max(i) AS n FROM r GROUP BY key),
ended AS (SELECT dp.key, dp.cost + 3 * runs.n AS cost, audit || repeat('I', runs.n) AS audit, made || ins AS made FROM dp LEFT JOIN m USING (key) JOIN runs ON runs.a = dp.a AND runs.b IN (0, 3) WHERE dp.i = coalesce(m.n, 0)),
best AS (SELECT * FROM ended QUALIFY row_number() OVER (PARTITION BY key ORDER BY cost, audit) = 1),
pairs AS (SELECT key, count(*) AS illegal FROM (SELECT key, i, lag(x) OVER (PARTITION BY key ORDER BY i) || x AS p FROM r) WHERE p NOT IN ('su', 'ua', 'au') GROUP BY key),
c AS (SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE f = 1) AS blank, count(*) FILTER (WHERE f = 2) AS duplicate, count(*) FILTER (WHERE f = 3) AS truncated, count(*) AS n_rows FROM r GROUP BY key)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
       sha256(made[2:]) AS repaired_sha256, coalesce(n_rows, 0) AS n_rows, CAST(length(replace(audit, 'D', '')) AS BIGINT) AS n_repaired
FROM n JOIN best USING (key) LEFT JOIN pairs USING (key) LEFT JOIN c USING (key)"""
