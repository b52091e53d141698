"""Orchard search and clustering against all distances."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np

from rosterlake.llm import centroids
from rosterlake.llm.centroids import Orchard

KIND = "vec_id long, embedding array<float>, label int, cluster string, distance string, v int"


def brute(rows, k, rounds, size, scale=64, seed=1):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    cents = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for n in range(len(cents)):
            mine = [v for (_, v), o in zip(kept, own) if o == n]
            if mine:
                cents[n] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for _, _, d in found)
    return sorted(((i, n, d, sum(e for _, m, e in found if m == n), total,
                    hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest())
                   for i, n, d in found), key=str)


def awkward(seed, n, size):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.gauss(0, .3), 0.25, -0.5]) for _ in range(size)], 1, "x", "y", 3)
            for i in range(n)]
    rows += rows[:9]                                         # repeated rows
    rows += [(900 + i, rows[0][1], 1, "x", "y", 3) for i in range(9)]   # ties
    rows += [(None, rows[3][1], 1, "x", "y", 3), (None, rows[4][1], 1, "x", "y", 3)]
    bad = [None, [], [0.1] * (size - 1), [0.1] * (size + 1), [None] + [0.1] * (size - 1),
           [float("nan")] + [0.1] * (size - 1), [float("inf")] + [0.1] * (size - 1)]
    return rows + [(800 + i, v, None, None, None, None) for i, v in enumerate(bad)]


def test_search_is_exact_and_measures_less():
    rng = np.random.default_rng(1)
    hubs = rng.integers(-400, 400, (32, 8))
    points = hubs[rng.integers(0, 32, 3000)] + rng.integers(-9, 9, (3000, 8))
    hubs[7] = hubs[3]                                        # equal centroids: the smaller number
    best, far, measured = Orchard(hubs).nearest(points)
    all_ = ((points[:, None, :] - hubs[None]) ** 2).sum(axis=2)
    assert (best == all_.argmin(axis=1)).all() and (far == all_.min(axis=1)).all()
    assert measured < 3000 * 32 / 2


def test_clusters_equal_brute_force(spark):
    for seed, k, size in [(1, 5, 4), (2, 16, 3), (3, 40, 2)]:
        rows = awkward(seed, 120, size)
        made = centroids.cluster_vectors(spark.createDataFrame(rows, KIND), k=k, size=size)
        assert sorted(map(tuple, made.collect()), key=str) == brute(rows, k, 3, size)


def test_too_few_and_none(spark):
    rows = awkward(4, 2, 3)[:2]
    made = centroids.cluster_vectors(spark.createDataFrame(rows, KIND), size=3)
    assert sorted(map(tuple, made.collect()), key=str) == brute(rows, 16, 3, 3)
    assert centroids.cluster_vectors(spark.createDataFrame([], KIND)).count() == 0
    huge = [(1, [1e30, 0.0], 1, "x", "y", 3)]
    assert centroids.cluster_vectors(spark.createDataFrame(huge, KIND), size=2).count() == 0
