"""Centroid clustering (k-means on integers) with Drake's adaptive distance bounds.

Each vector's row carries an upper bound on the distance to its centroid, the numbers of the next nearest centroids with a lower bound
each, and one lower bound for all others. When centroids have moved, bounds are shifted by how far. Where the upper bound
stays under all lower ones, the nearest centroid is certain and nothing is computed; else the own distance is taken, and then only the
listed centroids are rescanned whose order cannot be certified; all are, if the bound on the others does not hold either. Bounds are
floats with a margin, distances that decide are exact integers, so ties fall to the smaller number as if all distances had been taken.
How many bounds are kept follows what the rounds need: the most that any vector rescanned, `bounds` at first.

A round is one pass over the rows, without a shuffle, written with their bounds (the table before is then deleted), and one
aggregation over those that changed their cluster: sums and counts are carried on from the round before. The driver holds the centroids only.

Defined cases: vectors of another length, or with a null, NaN or infinite component, are left out; components beyond 2**53 after scaling count as 2**53
and distances beyond a long as the largest one; with fewer vectors than clusters each is a centroid; equal vectors are vectors of their own and may be
centroids twice; a null id is hashed as an empty one; of rows of one id the smaller vector comes first; a centroid without vectors stays; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .shared import discard, materialize

DIMENSION, CLUSTERS, ROUNDS, SEED = 64, 8, 10, 3
SCALE = 1024
BOUNDS = 3
MOST, LONG = 2**53, 2**63 - 1
EXACT = 2**21  # products of such components, and sums of 64 of them, are exact as floats
MARGIN = 1e-9
STATE = "cluster int, was int, upper double, near array<int>, low array<double>, rest double, used int"


@dataclass
class Model:
    centroids: list[list[int]]
    counts: list[int]
    sums: list[list[int]]
    bounds: list[int] = field(default_factory=list)  # kept in each round
    rescanned: list[int] = field(default_factory=list)  # vectors of each round for which any centroid but their own was looked at


def whole(vectors: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """vec_id, v: the vectors that count, as integers."""
    x = F.col("embedding")
    real = (F.size(x) == dimension) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    at = lambda e: F.floor(F.greatest(F.least(e.cast("double") * SCALE, F.lit(float(MOST))), F.lit(-float(MOST))))
    return vectors.filter(real).select("vec_id", F.transform(x, at).alias("v"))


def chosen(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors of the least hashes: `clusters` rows at most."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r["v"]) for r in vectors.orderBy(name, "v").limit(clusters).collect()]


def plain(x: np.ndarray, c: np.ndarray) -> bool:
    return max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) < EXACT and x.shape[-1] <= DIMENSION


def to_all(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to each centroid."""
    if plain(x, c):
        a, b = x.astype(float), c.astype(float)
        return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    a, b = x.astype(object), c.astype(object)
    return np.array([[((p - q) ** 2).sum() for q in b] for p in a], object).reshape(len(x), len(c))


def to_some(x: np.ndarray, c: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Exact squared distances of each vector to the centroids named in its row of ids."""
    if plain(x, c):
        gap = x[:, None, :] - c[ids]
        return np.einsum("nkd,nkd->nk", gap, gap)
    a, b = x.astype(object), c.astype(object)
    return np.array([[((p - b[k]) ** 2).sum() for k in own] for p, own in zip(a, ids)], object).reshape(ids.shape)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(d.astype(float))


def certain(upper: np.ndarray, low: np.ndarray) -> np.ndarray:
    return upper * (1 + MARGIN) + MARGIN < low * (1 - np.sign(low) * MARGIN)


@dataclass
class Bounds:
    """Of a batch: cluster, upper bound, near (ids) and low (their bounds), nearest first, rest; used: the listed centroids looked at, one more where all were."""

    cluster: np.ndarray
    upper: np.ndarray
    near: np.ndarray
    low: np.ndarray
    rest: np.ndarray
    used: np.ndarray


def fresh(x: np.ndarray, c: np.ndarray, bounds: int) -> Bounds:
    d = to_all(x, c)
    order = np.argsort(d, axis=1, kind="stable")
    sorted_ = root(np.take_along_axis(d, order, axis=1))
    rest = sorted_[:, bounds + 1] if len(c) > bounds + 1 else np.full(len(x), np.inf)
    return Bounds(order[:, 0], sorted_[:, 0], order[:, 1 : bounds + 1], sorted_[:, 1 : bounds + 1], rest, np.full(len(x), bounds + 1))


def moved(x: np.ndarray, c: np.ndarray, drift: np.ndarray, s: Bounds, bounds: int) -> Bounds:
    """The bounds after the centroids moved by `drift`, and the exact nearest centroid of each vector."""
    cluster, upper, near, used = s.cluster.copy(), s.upper + drift[s.cluster], s.near.copy(), np.zeros(len(x), np.int64)
    low, rest = s.low - drift[s.near], s.rest - drift.max(initial=0)
    if near.shape[1] > bounds:  # fewer are kept from now on; the others share the bound on the rest
        rest = np.minimum(rest, low[:, bounds:].min(axis=1))
        near, low = near[:, :bounds], low[:, :bounds]
    least = np.minimum.accumulate(np.concatenate([low, rest[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]  # of the j-th bound and all after
    todo = np.nonzero(~certain(upper, least[:, 0]))[0]
    own = to_some(x[todo], c, cluster[todo][:, None])[:, 0]
    upper[todo] = root(own)
    still = ~certain(upper[todo], least[todo, 0])
    todo, own = todo[still], own[still]
    need = (~certain(upper[todo][:, None], least[todo])).sum(axis=1)
    used[todo] = need
    for z in range(1, near.shape[1] + 1):
        at = todo[need == z]
        if not len(at):
            continue
        ids = np.concatenate([cluster[at][:, None], near[at, :z]], axis=1)
        d = np.concatenate([own[need == z][:, None], to_some(x[at], c, near[at, :z])], axis=1)
        order = np.array([sorted(range(z + 1), key=lambda j: (d[i, j], ids[i, j])) for i in range(len(at))]) if d.dtype == object else np.lexsort((ids, d), axis=1)
        ids, far = np.take_along_axis(ids, order, axis=1), root(np.take_along_axis(d, order, axis=1))
        cluster[at], upper[at] = ids[:, 0], far[:, 0]
        near[at, :z], low[at, :z] = ids[:, 1:], far[:, 1:]
    at = todo[need > near.shape[1]]
    if len(at):
        f = fresh(x[at], c, near.shape[1])
        cluster[at], upper[at], near[at], low[at], rest[at] = f.cluster, f.upper, f.near, f.low, f.rest
    return Bounds(cluster, upper, near, low, rest, used)


def matrix(batch: pa.RecordBatch, name: str, kind: type) -> np.ndarray:
    lists = K.column(batch, name)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(lists), -1) if len(lists) else np.zeros((0, 1), kind)


def assigned(rows: DataFrame, centroids: list[list[int]], drift: list[float] | None, bounds: int) -> DataFrame:
    """rows with their state after one assignment. drift: how far each centroid moved since the last one, None at the first."""
    kind, c = dict(rows.dtypes)["vec_id"], np.array(centroids, np.int64)
    names = ["vec_id", "v", "cluster", "was", "upper", "near", "low", "rest", "used"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch, "v", np.int64)
            was = pa.nulls(len(x), pa.int32())
            if drift is None:
                s = fresh(x, c, bounds)
            else:
                old = [K.column(batch, name).to_numpy() for name in ("cluster", "upper", "rest")]
                was = pa.array(old[0].astype(np.int32))
                s = moved(x, c, np.array(drift), Bounds(old[0].astype(np.int64), old[1], matrix(batch, "near", np.int64), matrix(batch, "low", float), old[2], old[2]), bounds)
            lists = [K.list_array(pa.array(values.astype(t).reshape(-1)), np.arange(len(x) + 1) * values.shape[1]) for values, t in ((s.near, np.int32), (s.low, float))]
            yield pa.RecordBatch.from_arrays([K.column(batch, "vec_id"), K.column(batch, "v"), pa.array(s.cluster.astype(np.int32)), was, pa.array(s.upper), *lists, pa.array(s.rest), pa.array(s.used.astype(np.int32))], names)
        K.release()

    return rows.mapInArrow(run, f"vec_id {kind}, v array<long>, {STATE}")


def changes(rows: DataFrame, dimension: int) -> list:
    """cluster, n, s0, s1, ...: what each cluster gains by the rows that changed theirs; a row a cluster."""
    each = F.explode(F.array(F.struct(F.col("cluster").alias("c"), F.lit(1).alias("sign")), F.struct(F.col("was").alias("c"), F.lit(-1).alias("sign")))).alias("to")
    to = rows.filter(~F.col("cluster").eqNullSafe(F.col("was"))).select("v", each).filter("to.c is not null").select("v", "to.c", "to.sign")
    sums = [F.sum((F.col("v")[i] * F.col("sign")).cast("decimal(20,0)")).alias(f"s{i}") for i in range(dimension)]
    return to.groupBy("c").agg(F.sum("sign").alias("n"), *sums).collect()


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, bounds: int = BOUNDS, dimension: int = DIMENSION) -> tuple[DataFrame, Model]:
    """The rows (vec_id, v, cluster, ...) after the last assignment, written, and the model."""
    own = materialize(whole(vectors, dimension), "vectors")
    centroids = chosen(own, clusters, seed)
    k = len(centroids)
    model = Model(centroids, [0] * k, [[0] * dimension for _ in range(k)])
    bounds, drift, rows = max(1, min(bounds, k - 1)), None, own
    if not k:
        return assigned(own, [[0] * dimension], None, 0), model
    bounds = min(bounds, k - 1)
    for last in range(rounds + 1):
        new = materialize(assigned(rows, model.centroids, drift, bounds), f"round-{last}")
        discard(rows)
        rows = new
        told = rows.agg(F.max("used").alias("most"), F.sum((F.col("used") > 0).cast("long")).alias("n")).first()
        model.bounds.append(bounds)
        model.rescanned.append(told["n"])
        if last == rounds:
            break
        for r in changes(rows, dimension):
            model.counts[r["c"]] += r["n"]
            model.sums[r["c"]] = [a + int(r[f"s{i}"]) for i, a in enumerate(model.sums[r["c"]])]
        now = [[s // n for s in sums] if n else old for sums, n, old in zip(model.sums, model.counts, model.centroids)]
        if now == model.centroids:
            break  # no later round would change anything
        drift = [float(np.sqrt(float(sum((a - b) ** 2 for a, b in zip(x, y))))) * (1 + MARGIN) for x, y in zip(now, model.centroids)]
        model.centroids = now
        bounds = min(bounds, max(1, told["most"])) if k > 1 else 0
    return rows, model


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, bounds: int = BOUNDS, dimension: int = DIMENSION) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: one row for each vector that counts."""
    rows, model = fit(vectors, clusters, rounds, seed, bounds, dimension)
    kind, c = dict(rows.dtypes)["vec_id"], np.array(model.centroids or [[0] * dimension], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = K.column(batch, "cluster")
            d = to_some(matrix(batch, "v", np.int64), c, at.to_numpy().astype(np.int64)[:, None])[:, 0] if len(at) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([K.column(batch, "vec_id"), at, pa.array([min(int(x), LONG) for x in d], pa.int64())], ["vec_id", "cluster", "distance"])

    out = materialize(rows.select("vec_id", "v", "cluster").mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), "clusters")
    if model.centroids:
        discard(rows)
    sums = {r["cluster"]: int(r["d"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect()}  # a row a cluster
    digest = lambda v: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()
    facts = [(k, min(sums.get(k, 0), LONG), min(sum(sums.values()), LONG), digest(v)) for k, v in enumerate(model.centroids)]
    told = out.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row a cluster


def oracle() -> str:
    """The same by full scans of all centroids in each round."""
    gap = "list_sum(list_transform(range(1, 65), lambda i: (k.v[i] - c.m[i]) * (k.v[i] - c.m[i])))"
    parts = [f"""k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {DIMENSION} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSION})""",
             f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m FROM (SELECT sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM k ORDER BY h, v LIMIT {CLUSTERS}))"]
    for t in range(ROUNDS + 1):
        parts.append(f"a{t} AS MATERIALIZED (SELECT r, min({{'d': {gap}, 'c': c.c}}) AS best FROM k, c{t} AS c GROUP BY r)")
        if t < ROUNDS:
            parts.append(f"""u{t} AS MATERIALIZED (SELECT c, list(q ORDER BY i) AS m FROM (SELECT c, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS q FROM (
  SELECT best.c AS c, i, CAST(sum(v[i]) AS HUGEINT) AS s, count(*) AS n FROM a{t} JOIN k USING (r), range(1, {DIMENSION + 1}) AS x(i) GROUP BY ALL)) GROUP BY c)""")
            parts.append(f"c{t + 1} AS MATERIALIZED (SELECT c.c, coalesce(u.m, c.m) AS m FROM c{t} AS c LEFT JOIN u{t} AS u USING (c))")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{ROUNDS} JOIN k USING (r) JOIN c{ROUNDS} AS f ON f.c = best.c"""
