import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.test_centroids import table

from citeloom.llm import voronoi



def integers(e, scale=64):
    return [math.floor(scale * float(x)) for x in map(np.float32, e)]


def brute_force(rows, k):
    kept = [
        (i, integers(e))
        for i, e in rows
        if e is not None and all(x is not None and math.isfinite(x) for x in e)
    ]
    out = []
    for at, (i, v) in enumerate(kept):
        if i is None or i % 20:
            continue
        scores = [
            (-sum(a * b for a, b in zip(v, w)), j is None, j)
            for other, (j, w) in enumerate(kept)
            if other != at
        ]
        out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(sorted(scores, key=lambda t: t[:2] + (t[2] or 0,))[:k], 1)]
    return sorted(out, key=repr)


def found(spark, rows, scratch, **options):
    got = voronoi.top_products(table(spark, rows), scratch, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def vectors(n, dimensions, groups, seed):
    rng = random.Random(seed)
    centers = [[rng.gauss(0, 3) for _ in range(dimensions)] for _ in range(groups)]
    return [(i, [rng.gauss(c, 0.2) for c in centers[rng.randrange(groups)]]) for i in range(n)]


@pytest.mark.parametrize("options", [{}, {"queries_per_group": 3, "vectors_per_slot": 40}])
def test_equals_brute_force(spark, scratch, options):
    rows = vectors(500, 5, 9, 3)
    assert found(spark, rows, scratch, k=7, **options) == brute_force(rows, 7)


def test_copies_of_one_vector(spark, scratch):
    rows = vectors(200, 4, 5, 4)
    rows += [(1_000 + i, rows[0][1]) for i in range(150)]
    got = found(spark, rows, scratch, k=6, queries_per_group=2, vectors_per_slot=30)
    assert got == brute_force(rows, 6)


def test_odd_vectors(spark, scratch):
    rows = [(0, [1.0, 2.0]), (20, None), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("-inf"), 1.0])]
    rows += [(100, []), (120, [3.0]), (3, [2.0, 2.0, 9.0]), (None, [1.0, 2.0]), (0, [1.0, 2.0]), (5, [1.0, 2.0])]
    assert found(spark, rows, scratch, k=4) == brute_force(rows, 4)
    assert found(spark, rows, scratch, k=50) == brute_force(rows, 50)


def test_nothing_to_search(spark, scratch):
    assert found(spark, [], scratch) == []
    assert found(spark, [(1, [1.0])], scratch) == []
    assert found(spark, [(20, [1.0])], scratch) == []
    with pytest.raises(ValueError):
        voronoi.top_products(table(spark, []), scratch, k=0)


def test_large_components_stay_exact(spark, scratch):
    rows = [(i, [3e4 * (i % 7) + i, 2e5 - i, -1e5 + i * i]) for i in range(0, 90)]
    assert found(spark, rows, scratch, k=5) == brute_force(rows, 5)
    assert len(found(spark, rows + [(100, [3e38] * 3)], scratch, k=5)) == 6 * 5


def test_other_queries(spark, scratch):
    rows = vectors(80, 3, 4, 9)
    got = found(spark, rows, scratch, k=1, is_query=F.col("vec_id") < 2)
    assert [r[:2] for r in got] == [(0, 1), (1, 1)]


def test_far_cells_are_not_sent():
    """With clear clusters, a cell's reach leaves the vectors of others out."""
    rng = np.random.default_rng(2)
    centers = np.array([[90_000, 0], [-90_000, 0], [0, 90_000], [0, -90_000]])
    data = np.concatenate([c + rng.integers(-50, 50, (200, 2)) for c in centers])
    longest = int((data**2).sum(axis=1).max())
    plan = voronoi.Plan(centers, longest)
    lifted = plan.distances(data, lifted=True)
    cell = lifted.argmin(axis=1)
    asked = plan.distances(data[::20], lifted=False)
    asked_cell = asked.argmin(axis=1)
    own = asked[np.arange(len(asked)), asked_cell]
    count = np.bincount(asked_cell, minlength=4)
    low = np.array([own[asked_cell == c].min() for c in range(4)])
    high = np.array([own[asked_cell == c].max() for c in range(4)])
    plan.bound(lifted[np.arange(len(data)), cell], cell, low, high, count, 5, 10)
    wanted = plan.wanted(lifted)
    assert plan.groups == 4
    assert (wanted.sum(axis=1) == 1).all()


def test_best_takes_the_leftmost_of_equal_scores():
    scores = np.array([[1.0, 5, 5, 5, 2], [3, 3, 3, 3, 3], [9, 1, 8, 1, 1]])
    assert voronoi.best(scores, 2).tolist() == [[1, 2], [0, 1], [0, 2]]
    assert voronoi.best(scores, 9).shape == (3, 5)
