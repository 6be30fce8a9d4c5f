"""Hard negatives against brute force: odd rows, ties, several trees and chunks, large numbers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import negatives as neg

KIND = "vec_id long, embedding array<double>, label int"


def brute(rows, anchor, positives=5, negatives=10):
    seen = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen[i] = min(seen.get(i, (y, v)), (y, v))
    ints = {i: (y, [math.floor(256 * x) for x in v]) for i, (y, v) in seen.items()}

    def dot(a, b):
        return sum(p * q for p, q in zip(a, b))

    out = []
    for a, (y, v) in ints.items():
        if not anchor(a):
            continue
        scores = [(-dot(v, w), i, z) for i, (z, w) in ints.items() if i != a]
        scores.sort()
        for ps, p, _ in [s for s in scores if s[2] == y][:positives]:
            fit = [(i, -s) for s, i, z in scores if z != y and 30 * -ps <= 100 * -s <= 90 * -ps]
            out += [(a, p, k + 1, i, -ps, s) for k, (i, s) in enumerate(fit[:negatives])]
    return sorted(out)


def rows_of(seed, n, spread, d=8):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    out = []
    for k in range(n):
        c = rng.choice(centres)
        out.append((k - 20, [round(x + rng.gauss(0, spread), 2) for x in c], rng.choice([0, 0, 0, 1, 2, 3])))
    return out


ODD = [
    (None, [1.0] * 8, 0), (5000, None, 0), (5001, [1.0] * 8, None), (5002, [1.0, None] + [0.0] * 6, 0), (5003, [float("nan")] * 8, 1),
    (5004, [float("inf")] * 8, 1), (5005, [], 0), (5006, [1.0, 2.0], 1), (5010, [1.0] * 8, 9), (5011, [0.0] * 8, 2),
    (5020, [1.0] * 8, 2), (5020, [2.0] * 8, 1), (5020, [1.0] * 8, 1), (5030, [3.0] * 8, 2), (5040, [3.0] * 8, 2), (5050, [3.0] * 8, 0),
]


def run(spark, rows, sizes=(512, 4096), every=10):
    frame = spark.createDataFrame(rows, KIND).repartition(3).select("*", *[F.lit(1).alias(c) for c in ("id", "vec", "block", "chunk", "place", "rank")])
    out = neg.hard_negatives(neg.usable_rows(frame), F.col("id") % every == 0, anchors=sizes[0], chunk=sizes[1])
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("spread,sizes", [(0.05, (512, 4096)), (0.05, (7, 50)), (1.0, (7, 50))])
def test_matches_brute_force(spark, spread, sizes):
    rows = rows_of(int(spread * 100), 400, spread) + ODD
    assert run(spark, rows, sizes) == brute(rows, lambda i: i % 10 == 0)


def test_large_numbers_and_empty(spark):
    rows = [(k, [float(k + 1) * 2.0**17, float(k % 3) - 1.5], k % 2) for k in range(40)]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert run(spark, []) == []
    assert run(spark, [(10, [1.0], 1)]) == []


def test_bounds_hold_and_save_work():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 60, (5, 32))
    anchors = np.floor(centres[np.arange(60) % 5] + rng.normal(0, 2, (60, 32)))
    rows = np.floor(centres[rng.integers(0, 5, 500)] + rng.normal(0, 2, (500, 32)))
    order, parent, edge = neg.spanning_tree(anchors)
    assert sorted(order) == list(range(60)) and all(p < k for k, p in enumerate(parent))
    b = neg.Bounds(rows, anchors[order], parent, edge)
    exact = rows @ anchors[order].T
    for k in range(60):
        low, high = b.enter(k)
        assert (low <= exact[:, k] + 1e-6).all() and (exact[:, k] <= high + 1e-6).all()
        best = neg._least_of(low, 10)
        b.score(k, np.flatnonzero(high >= best))
        b.leave(k)
    assert b.scored < 0.5 * exact.size and not b.low
