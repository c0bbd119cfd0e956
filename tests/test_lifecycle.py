"""Likely same descriptions: by segments as by all pairs, and how many are compared."""

import random

import pytest
from pyspark.sql import functions as F

from foliant.operators import lifecycle

SCHEMA = "thread string, body string, description string, provisions array<string>"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def texts(rng, n, longest=50):
    out = []
    while len(out) < n:
        if out and rng.random() < 0.5:
            x = list(rng.choice(out))
            for _ in range(rng.randint(0, 2 + len(x) // 3)):
                at = rng.randrange(len(x) + 1)
                x[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "z"])
            out.append("".join(x))
        else:
            out.append("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, longest))))
    return out


@pytest.mark.parametrize("most", [0.0, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6])
def test_segments_lose_no_pair(spark, most):
    rng = random.Random(int(most * 100))
    rows = [(f"t{i}", rng.choice(["A", "A", None]), x, rng.choice([["9"], ["9", "8"], ["9", None]])) for i, x in enumerate(texts(rng, 160) + ["", "a", "ab", "abc"])]
    got = {(r.thread, r.other): r.distance for r in lifecycle.likely_same(spark.createDataFrame(rows, SCHEMA), most, small=3).collect()}
    want = {}
    for i, (t, b, x, p) in enumerate(rows):
        for u, c, y, q in rows[:i]:
            if b == c and set(p) & set(q):
                d = distance(x, y) / max(len(x), len(y), 1)
                if d <= most:
                    want[(t, u) if (x, t) < (y, u) else (u, t)] = d
    assert got == pytest.approx(want) and set(got) == set(want)


def test_few_are_compared_in_a_large_block(spark):
    """8,000 descriptions of one block: of 32 million pairs, under one in a thousand are compared at a tenth, and every planted pair is found."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    own = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 9))) for _ in range(7_800)]
    own += [x[:7] + "#" + x[9:] for x in own[:200]]
    rows = spark.createDataFrame([(f"t{i}", "A", x, ["9"]) for i, x in enumerate(own)], SCHEMA)
    each = rows.select(F.monotonically_increasing_id().alias("_i"), F.lit("b").alias("_block"), "description", F.length("description").alias("_size"))
    n = lifecycle.candidates(each.withColumn("_band", lifecycle.band(F.col("_size"), 0.1)), 0.1).count()
    assert 200 <= n < 8_000**2 / 2 / 1000
    found = {(r.thread, r.other) for r in lifecycle.likely_same(rows, 0.1).collect()}
    assert all((f"t{i}", f"t{7800 + i}") in found or (f"t{7800 + i}", f"t{i}") in found for i in range(200))
