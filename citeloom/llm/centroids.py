"""Centroid clustering of integer vectors through a vantage-point tree over the centroids.

Vectors are turned into integers, so that every distance, sum and tie is exact. A round builds a
tree over the centroids, broadcasts it and lets tasks find each vector's nearest centroid; tasks
return counts and component sums per centroid, which Spark adds up, and the new centroids are the
floors of the means. What is gathered and broadcast is bounded by the number of centroids, which
is a parameter, and their dimensions. A round that changes no centroid ends the rounds early: all
later ones would be equal.

In the tree, a node holds one centroid as vantage point and two children, the nearer and the
farther half of the others, with the least and greatest distance to the vantage point in each; a
leaf holds a few centroids. A vector opens nodes best first, by a lower bound of the distance to
whatever is inside, and stops when the least bound exceeds the best distance found. A bound that
only equals it is still opened, as the centroid inside may have a smaller number. Bounds are
floating and lowered by more than their error; distances that decide are integers. All vectors of
a batch take their steps together, each at the node of its own.

Cases: vectors that are null, hold null or non-finite components or have another number of
components are left out; integers beyond 2^27 either way are taken as that, so that squared
distances fit in a long (sums of them that do not are null); with fewer vectors than centroids
there are as many centroids as vectors; rows with the same id count one by one, and where they
compete as first centroids the smaller vector comes first; null ids come last there; no vectors,
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.session import importable
from citeloom.llm.vectors import is_finite, matrix, whole
from citeloom.scratch import Scratch

BOUND = 1 << 27
# Centroids in a leaf at most.
LEAF = 3
# Bounds held at a time while a batch of vectors is searched.
CELLS = 1 << 21
# Relative error allowed for in bounds, far more than a few roundings.
SLACK = 1e-9

Centroids = list[list[int]]


def _squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    apart = points - centers
    return np.einsum("...i,...i->...", apart, apart)


class VantageTree:
    """Nearest of a set of integer points; of those equally near, the one with the least number."""

    def __init__(self, points: Centroids, leaf: int = LEAF):
        self.points = np.array(points, np.int64)
        # Per node: its own points (one vantage point, or a leaf's), and (child, least, greatest).
        self.own: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        waiting = [(self._node(), np.arange(len(points)))]
        while waiting:
            node, members = waiting.pop()
            if len(members) <= leaf:
                self.own[node] = members
                continue
            vantage, others = members[0], members[1:]
            away = np.sqrt(_squared(self.points[others], self.points[vantage]).astype(float))
            order = np.argsort(away, kind="stable")
            half = len(order) // 2
            self.own[node] = members[:1]
            for side in (order[:half], order[half:]):
                if len(side):
                    child = self._node()
                    self.children[node].append((child, away[side].min(), away[side].max()))
                    waiting.append((child, np.sort(others[side])))

    def _node(self) -> int:
        self.own.append(np.empty(0, np.int64))
        self.children.append([])
        return len(self.own) - 1

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(number, squared distance)`` of the nearest point to each vector."""
        step = max(1, CELLS // len(self.own))
        found = [self._search(vectors[i : i + step]) for i in range(0, len(vectors), step)]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(vectors)
        number = np.full(n, len(self.points), np.int64)
        least = np.full(n, np.iinfo(np.int64).max, np.int64)
        # Nodes that wait to be opened, by their bound; what is opened or unknown is infinite.
        bounds = np.full((n, len(self.own)), np.inf)
        bounds[:, 0] = 0.0
        active = np.arange(n)
        while True:
            node = bounds[active].argmin(axis=1)
            bound = bounds[active, node]
            open_ = bound <= np.sqrt(least[active].astype(float)) * (1 + SLACK)
            active, node, bound = active[open_], node[open_], bound[open_]
            if not len(active):
                return number, least
            bounds[active, node] = np.inf
            for opened in np.unique(node):
                at = node == opened
                self._open(opened, vectors, active[at], bound[at], bounds, number, least)

    def _open(self, node, vectors, rows, bound, bounds, number, least) -> None:
        here = vectors[rows]
        for point in self.own[node]:
            squared = _squared(here, self.points[point])
            better = (squared < least[rows]) | ((squared == least[rows]) & (point < number[rows]))
            least[rows[better]] = squared[better]
            number[rows[better]] = point
            away = np.sqrt(squared.astype(float))
        for child, low, high in self.children[node]:
            inside = np.maximum(away - high, low - away) - SLACK * (away + high)
            bounds[rows, child] = np.maximum(bound, inside)


def _assign(tree: Broadcast, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, squared = tree.value.nearest(matrix(batch.column("v"), dimensions))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(squared, pa.int64())],
                ["vec_id", "cluster", "distance"],
            )

    return run


def _sums(tree: Broadcast, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.value.points)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            vectors = matrix(batch.column("v"), dimensions)
            number, _ = tree.value.nearest(vectors)
            order = np.argsort(number, kind="stable")
            met, begins, n = np.unique(number[order], return_index=True, return_counts=True)
            if len(met):
                counts[met] += n
                sums[met] += np.add.reduceat(vectors[order], begins)
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(met, pa.int32()),
                pa.array(counts[met], pa.int64()),
                pa.array(list(sums[met]), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    return run


def _moved(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids after one round."""
    spark, dimensions = vectors.sparkSession, len(centroids[0])
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    parts = vectors.mapInArrow(
        _sums(tree, dimensions), "cluster int, n bigint, sums array<bigint>"
    ).select("cluster", "n", F.posexplode("sums").alias("place", "total"))
    # One row per centroid and component.
    added = parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    )
    moved = [list(c) for c in centroids]
    for row in added.collect():
        moved[row["cluster"]][row["place"]] = int(row["total"]) // row["n"]
    tree.destroy()
    return moved


def _integers(vectors: DataFrame, dimensions: int, scale: int) -> DataFrame:
    given = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").alias("e"))
    kept = given.where((F.size("e") == dimensions) & is_finite(F.col("e")))
    return kept.select("vec_id", whole(F.col("e"), scale, BOUND).alias("v"))


def _first(integers: DataFrame, k: int, seed: str) -> Centroids:
    label = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    chosen = integers.orderBy(label.asc_nulls_last(), "v").limit(k)
    return [list(r["v"]) for r in chosen.collect()]


def cluster(
    vectors: DataFrame,
    scratch: Scratch,
    *,
    k: int = 8,
    rounds: int = 10,
    dimensions: int = 64,
    scale: int = 1024,
    seed: str = "3:",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector.

    ``vectors`` has columns ``vec_id`` and ``embedding``. The first centroids are the ``k``
    vectors whose ids, after ``seed``, have the smallest SHA-256.
    """
    spark = vectors.sparkSession
    importable(spark)
    integers = scratch.keep(_integers(vectors, dimensions, scale), "integers")
    centroids = _first(integers, k, seed)
    if not centroids:
        return integers.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in _ADDED])
    for _ in range(rounds):
        moved = _moved(integers, centroids)
        if moved == centroids:
            break
        centroids = moved
    tree = spark.sparkContext.broadcast(VantageTree(centroids))
    placed = scratch.keep(
        integers.mapInArrow(
            _assign(tree, dimensions), "vec_id bigint, cluster int, distance bigint"
        ),
        "placed",
    )
    tree.destroy()
    return placed.join(F.broadcast(_summary(spark, placed, centroids)), "cluster").select(
        "vec_id", *[c for c, _ in _ADDED]
    )


_ADDED = [
    ("cluster", "int"),
    ("distance", "bigint"),
    ("cluster_inertia", "bigint"),
    ("inertia", "bigint"),
    ("centroid_sha256", "string"),
]


def _summary(spark: SparkSession, placed: DataFrame, centroids: Centroids) -> DataFrame:
    """One row per centroid that has vectors."""
    sums = placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")
    )
    inertia = {r["cluster"]: int(r["inertia"]) for r in sums.collect()}

    def as_long(total: int) -> int | None:
        return total if total < 1 << 63 else None

    rows = [
        (
            number,
            as_long(own),
            as_long(sum(inertia.values())),
            hashlib.sha256(",".join(map(str, centroids[number])).encode()).hexdigest(),
        )
        for number, own in inertia.items()
    ]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    return spark.createDataFrame(rows, schema)
