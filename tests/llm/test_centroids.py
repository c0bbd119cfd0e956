import hashlib
import random

import numpy as np
import pytest

from foliant.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, v string, cluster string, was int"


def make(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", "c", 1) for i, v in rows], SCHEMA)


def brute(rows, clusters=8, rounds=10, seed=3, dimension=64):
    kept = [(i, [min(max(int(np.floor(x * 1024)), -(2**53)), 2**53) for x in v]) for i, v in rows if v is not None and len(v) == dimension and all(x is not None and np.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    c = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:clusters]]
    far = lambda v, m: sum((a - b) ** 2 for a, b in zip(v, m))
    nearest = lambda v: min(range(len(c)), key=lambda k: (far(v, c[k]), k))
    for _ in range(rounds):
        at = [nearest(v) for _, v in kept]
        for k in set(at):
            own = [v for (_, v), a in zip(kept, at) if a == k]
            c[k] = [sum(x) // len(own) for x in zip(*own)]
    at = [nearest(v) for _, v in kept]
    d = [min(far(v, c[a]), 2**63 - 1) for (_, v), a in zip(kept, at)]
    most = 2**63 - 1
    per = {k: min(sum(x for x, a in zip(d, at) if a == k), most) for k in set(at)}
    return sorted([(i, a, x, per[a], min(sum(d), most), hashlib.sha256(",".join(map(str, c[a])).encode()).hexdigest()) for (i, _), a, x in zip(kept, at, d)], key=repr)


def blobs(rng, n, dimension, spread=0.05):
    at = [[rng.uniform(-1, 1) for _ in range(dimension)] for _ in range(5)]
    return [[x + rng.gauss(0, spread) for x in rng.choice(at)] for _ in range(n)]


@pytest.mark.parametrize("bounds", [1, 3, 7])
def test_against_full_scans(spark, bounds):
    rng = random.Random(bounds)
    vectors = blobs(rng, 150, 64, 0.4) + [[0.0] * 64] * 30 + [[0.5] * 64] * 3
    rows = list(enumerate(vectors)) + [(None, vectors[3]), (7, vectors[9]), (7, vectors[8]), (900, None), (901, []), (902, [0.1] * 63), (903, [float("nan")] + [0.0] * 63), (904, [float("inf")] * 64), (905, [None] + [1.0] * 63)]
    got = sorted([tuple(r) for r in centroids.cluster(make(spark, rows), bounds=bounds).collect()], key=repr)
    assert got == brute(rows)


def test_ties_fall_to_the_smaller_number(spark):
    """Vectors on a small grid, where many are as near to one centroid as to another."""
    rng = random.Random(2)
    rows = [(i, [rng.randint(0, 2) / 1024 for _ in range(2)]) for i in range(120)]
    for k in (2, 5, 8):
        got = sorted([tuple(r) for r in centroids.cluster(make(spark, rows), clusters=k, dimension=2, bounds=2).collect()], key=repr)
        assert got == brute(rows, clusters=k, dimension=2)


def test_very_large_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([1e30, -1e9, 3e6, 0.25, -7e12]) * rng.random() for _ in range(64)]) for i in range(40)]
    assert sorted([tuple(r) for r in centroids.cluster(make(spark, rows)).collect()], key=repr) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 5])
def test_fewer_vectors_than_clusters(spark, n):
    rows = [(i, [float(i)] * 64) for i in range(n)]
    assert sorted([tuple(r) for r in centroids.cluster(make(spark, rows)).collect()], key=repr) == brute(rows)


def test_most_vectors_are_certified_without_a_scan(spark):
    rows = list(enumerate(blobs(random.Random(5), 600, 64)))
    _, model = centroids.fit(make(spark, rows))
    assert model.rescanned[0] == 600 and sum(model.rescanned[3:]) < 600 and model.bounds[-1] < model.bounds[0]


def test_bounds_hold_after_every_move():
    """Lower bounds stay under the true distances, upper ones over them, while centroids wander."""
    rng = np.random.default_rng(7)
    x, c = rng.integers(-300, 300, (400, 8)), rng.integers(-300, 300, (9, 8))
    s = centroids.fresh(x, c, 4)
    for t in range(12):
        new = c + rng.integers(-25, 26, c.shape) // (t + 1)
        drift = np.sqrt(((new - c) ** 2).sum(axis=1)) * (1 + centroids.MARGIN)
        c, s = new, centroids.moved(x, new, drift, s, 4 if t < 6 else 2)
        d = np.sqrt(centroids.to_all(x, c).astype(float))
        assert (s.cluster == centroids.to_all(x, c).argmin(axis=1)).all() and (s.upper >= d[np.arange(400), s.cluster] * (1 - 1e-6)).all()
        assert (s.low <= np.take_along_axis(d, s.near, axis=1) * (1 + 1e-6)).all()
        rest = d.copy()
        np.put_along_axis(rest, np.concatenate([s.cluster[:, None], s.near], axis=1), np.inf, axis=1)
        assert (s.rest <= rest.min(axis=1) * (1 + 1e-6) + 1e-6).all()
