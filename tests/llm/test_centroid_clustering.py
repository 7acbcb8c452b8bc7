"""Operator 11 against plain rounds over full distances in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from postlens.llm import centroid_clustering as op


def plain(rows, k, rounds, dim, scale=256):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in first[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        to = [j for _, j in nearest()]
        for j in range(len(centroids)):
            own = [v for (_, v), t in zip(kept, to) if t == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    last = nearest()
    held = lambda x: x if x < 1 << 63 else None
    total = held(sum(d for d, _ in last))
    return sorted(((i, j, held(d), held(sum(e for e, t in last if t == j)), total,
                    hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for (i, _), (d, j) in zip(kept, last)), key=str)


def clusters(spark, rows, k, rounds, dim):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, cluster string, n int")
    names = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    got = op.centroid_clusters(spark, df.repartition(3), k, rounds, dim).collect()
    return sorted((tuple(r[n] for n in names) for r in got), key=str)


def single(x):
    return float(np.float32(x))


def test_small_whole_numbers_with_ties(spark):
    rng = random.Random(2)
    rows = [(i, [single(rng.randrange(-3, 4)) / 256 for _ in range(4)]) for i in range(300)]
    assert clusters(spark, rows, 12, 5, 4) == plain(rows, 12, 5, 4)


def test_unusable_repeated_and_null(spark):
    rng = random.Random(3)
    vec = lambda: [single(rng.gauss(0, 1)) for _ in range(8)]
    same = vec()
    rows = [(i, vec()) for i in range(80)] + [(3, same), (3, same), (90, same), (91, same), (None, vec()), (None, vec())]
    rows += [(100, None), (101, []), (102, vec()[:7]), (103, vec() + [1.0]), (104, [None] + vec()[1:]), (105, [math.nan] * 8),
             (106, [math.inf] + vec()[1:]), (107, [0.0] * 8), (108, [-0.0] * 8)]
    assert clusters(spark, rows, 10, 4, 8) == plain(rows, 10, 4, 8)
    assert clusters(spark, rows[:4], 10, 4, 8) == plain(rows[:4], 10, 4, 8)


@pytest.mark.parametrize("size", [1e5, 1e9, 1e15])
def test_large_components(spark, size):
    rng = random.Random(4)
    rows = [(i, [single(rng.gauss(0, size)) for _ in range(3)]) for i in range(60)]
    assert clusters(spark, rows, 5, 3, 3) == plain(rows, 5, 3, 3)


def test_empty(spark):
    assert clusters(spark, [(1, None)], 5, 2, 3) == [] and clusters(spark, [(1, [1.0])], 5, 2, 3) == []


def test_tournament_prefers_the_smaller_number():
    planes = op.Bisectors([[0, 0], [2, 0], [0, 2], [0, 0]])
    winner, distance = planes.nearest(np.array([[1, 0], [1, 1], [0, 0], [2, 1], [-5, 7]]))
    assert winner.tolist() == [0, 0, 0, 1, 2] and distance.tolist() == [1, 2, 0, 1, 50]
