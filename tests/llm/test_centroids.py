import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from citeloom.llm import centroids
from citeloom.llm.centroids import VantageTree

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("cluster", T.StringType()),
        T.StructField("v", T.StringType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(i, e, "x", "y") for i, e in rows], SCHEMA).repartition(3)


def brute_force(rows, k, rounds, dimensions):
    kept = [
        (i, [math.floor(1024 * float(x)) for x in map(np.float32, e)])
        for i, e in rows
        if e is not None and len(e) == dimensions and all(x is not None and math.isfinite(x) for x in e)
    ]
    named = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    cs = [v for _, v in sorted(named)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in kept]
        for n in range(len(cs)):
            own = [v for (_, v), c in zip(kept, of) if c == n]
            if own:
                cs[n] = [sum(x) // len(own) for x in zip(*own)]
    placed = [(i, *nearest(v)[::-1]) for i, v in kept]
    total = sum(d for *_, d in placed)
    own = {n: sum(d for _, c, d in placed if c == n) for n in range(len(cs))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted((i, n, d, own[n], total, sha[n]) for i, n, d in placed)


def clustered(spark, rows, scratch, **options):
    got = centroids.cluster(table(spark, rows), scratch, **options)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force(spark, scratch):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(i % 4, 0.3) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(60)]  # one vector many times
    rows += [(300, None), (301, [1.0] * 5), (302, [1.0, None] * 3), (303, [float("nan")] * 6), (304, [float("inf")] * 6)]
    rows += [(300, [0.5] * 6), (5, rows[5][1])]
    got = clustered(spark, rows, scratch, k=7, rounds=10, dimensions=6)
    assert got == brute_force(rows, 7, 10, 6)


def test_ties_go_to_the_smaller_number(spark, scratch):
    rows = [(i, [float(i % 2), 0.0]) for i in range(12)] + [(20, [0.5, 0.0]), (21, [0.5, 3.0])]
    for rounds in (0, 1, 4):
        assert clustered(spark, rows, scratch, k=5, rounds=rounds, dimensions=2) == brute_force(rows, 5, rounds, 2)


def test_fewer_vectors_than_centroids_and_none(spark, scratch):
    rows = [(1, [0.25, -0.5]), (2, [1.0, 1.0])]
    assert clustered(spark, rows, scratch, dimensions=2) == brute_force(rows, 8, 10, 2)
    assert clustered(spark, [], scratch) == []
    assert clustered(spark, [(1, None), (2, [])], scratch) == []


def test_null_ids_and_huge_components(spark, scratch):
    rows = [(None, [0.0, 0.0]), (1, [0.0, 1.0]), (2, [3e38, -3e38]), (3, [1.0, 0.0])]
    got = clustered_any(spark, rows, scratch)
    assert len(got) == 4 and all(r["distance"] >= 0 for r in got)


def clustered_any(spark, rows, scratch):
    return centroids.cluster(table(spark, rows), scratch, k=3, rounds=2, dimensions=2).collect()


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_nearest_of_many(seed):
    rng = np.random.default_rng(seed)
    spread = [2, 5, 30, 1_000, 1 << 20, 1 << 27][seed]
    points = rng.integers(-spread, spread, (90, 3))
    points[40:45] = points[3]
    vectors = np.concatenate([rng.integers(-spread, spread, (400, 3)), points])
    number, squared = VantageTree(points.tolist()).nearest(vectors)
    apart = vectors[:, None, :] - points[None]
    every = (apart * apart).sum(axis=2)
    assert (squared == every.min(axis=1)).all()
    assert (number == every.argmin(axis=1)).all()
