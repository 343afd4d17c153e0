"""Exact search for the vectors of greatest inner product, as a join over Voronoi cells.

Inner products become distances: give every vector the extra component that brings its length to
that of the longest one, and every query a zero there; then ``distance² = |query|² + longest² -
2 x product``, and a query's highest products are its nearest vectors. Distances obey the triangle
inequality, which the join rests on:

* A bounded sample of vectors serves as pivots. Each query and each vector belongs to the cell of
  its nearest pivot. A cell's summary holds, for its vectors, the ``k + 1`` smallest distances to
  the pivot, and for its queries their number and their least and greatest distance.
* From summaries alone follows, per cell of queries, a distance within which each of its queries
  has ``k`` neighbours: the ``k + 1``-th smallest of greatest query distance + distance of pivots +
  vector distance, one more as a query may meet itself.
* A vector is sent to a cell of queries only if its distance to that cell's pivot leaves it within
  that reach of some query. Cells that lie near each other are joined into groups of a bounded
  number of queries, and a cell with more is split, so a vector is copied once per group at most.
* A group's vectors are dealt over slots of a bounded number by the hash of their row, and the
  group's queries copied to each, so no task grows with a cell. Each task solves its part exactly,
  in blocks; a query's parts are then merged by a ranking over ``k`` rows per slot.

The floating distances only decide what is sent, with more slack than their error; scores are
exact integers. Where vectors are alike in no dimension, as random ones, bounds prune little and
every group gets nearly all vectors: then it is a block join, whose copies per vector are the
number of groups.

Cases: vectors that are null or hold null or non-finite components take no part, as query or
candidate; an empty vector and one shorter than others count as ending in zeros; integers beyond
2^24 either way are taken as that, so that scores fit in a long; a query is kept from its own row
only, so a repeated row meets its twin; null ids are never queries and come last among ties; an
empty table, or one with no query, gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from citeloom.llm.session import importable
from citeloom.llm.vectors import is_finite, matrix, whole
from citeloom.scratch import Scratch

BOUND = 1 << 24
# Pivots: one per so many queries, within these bounds.
QUERIES_PER_PIVOT, FEWEST_PIVOTS, MOST_PIVOTS = 256, 8, 512
# Queries in a group and vectors in a slot, at most and about.
QUERIES_PER_GROUP = 16_384
VECTORS_PER_SLOT = 16_384
# Scores held at a time while a slot is solved.
CELLS = 1 << 21
# Part of the longest possible distance that rounding may put wrong.
SLACK = 1e-6


class Plan:
    """Pivots, what is known of their cells, and which group each cell of queries is in."""

    def __init__(self, pivots: np.ndarray, longest: int):
        self.pivots = pivots.astype(float)
        self.longest = float(longest)
        self.lift = np.sqrt(np.maximum(self.longest - (self.pivots**2).sum(axis=1), 0))
        between = 2 * (self.longest - self.pivots @ self.pivots.T - np.outer(self.lift, self.lift))
        self.between = np.sqrt(np.maximum(between, 0))
        np.fill_diagonal(self.between, 0)
        self.slack = SLACK * (1 + 2 * np.sqrt(self.longest))
        self.slots = np.zeros(0, np.int64)

    def distances(self, vectors: np.ndarray, lifted: bool) -> np.ndarray:
        """From each vector to each pivot; queries are not lifted."""
        points = vectors.astype(float)
        norms = (points**2).sum(axis=1)
        squared = self.longest - 2 * points @ self.pivots.T
        if lifted:
            lift = np.sqrt(np.maximum(self.longest - norms, 0))
            squared += self.longest - 2 * np.outer(lift, self.lift)
        else:
            squared += norms[:, None]
        return np.sqrt(np.maximum(squared, 0))

    def bound(self, near: np.ndarray, cells: np.ndarray, low, high, count, k: int, per_group: int):
        """Work out each cell's reach from the summaries, and deal the cells into groups.

        ``near`` and ``cells`` are the kept distances of vectors to their pivots; ``low``,
        ``high`` and ``count`` describe the queries of each cell.
        """
        n = len(self.pivots)
        self.count = count
        self.reach = np.full(n, np.inf)
        if len(near) > k:
            for cell in np.flatnonzero(count):
                upper = high[cell] + self.between[cell, cells] + near
                self.reach[cell] = np.partition(upper, k)[k]
        self.least = np.where(count > 0, low, 0) - self.reach - self.slack
        self.most = high + self.reach + self.slack
        self.first, self.parts = np.full(n, -1, np.int64), np.ones(n, np.int64)
        group, room, at = -1, 0, 0
        left = set(np.flatnonzero(count).tolist())
        while left:
            at = min(left, key=lambda cell: (self.between[at, cell], cell))
            left.remove(at)
            if count[at] > per_group:
                self.parts[at] = -(-count[at] // per_group)
                self.first[at], group, room = group + 1, group + self.parts[at], 0
                continue
            if count[at] > room:
                group, room = group + 1, per_group
            self.first[at] = group
            room -= count[at]
        self.groups = group + 1

    def wanted(self, distances: np.ndarray) -> np.ndarray:
        """Which groups need each vector, as a table of truth values."""
        out = np.zeros((len(distances), self.groups), bool)
        for cell in np.flatnonzero(self.count):
            within = (distances[:, cell] >= self.least[cell]) & (
                distances[:, cell] <= self.most[cell]
            )
            out[:, self.first[cell] : self.first[cell] + self.parts[cell]] |= within[:, None]
        return out


def _spread(rows: np.ndarray, salt: int) -> np.ndarray:
    """A hash of row numbers."""
    mixed = (rows.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    return (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)


def _points(vectors: DataFrame, is_query: Column, scale: int) -> DataFrame:
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("e"))
    finite = given.where(is_finite(F.col("e")))
    zero = F.lit(0).cast("bigint")
    points = finite.select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        whole(F.col("e"), scale, BOUND).alias("v"),
    )
    norm = F.aggregate("v", zero, lambda total, x: total + x.cast("bigint") * x.cast("bigint"))
    return points.withColumn("norm", norm)


def _pivots(points: DataFrame, n: int, dimensions: int) -> np.ndarray:
    """Distinct vectors of the rows with the smallest hashes; a bounded sample of them."""
    sample = points.orderBy(F.xxhash64("vec_id", "v"), "vec_id", "v").select("v").limit(4 * n).collect()
    chosen = list(dict.fromkeys(tuple(r["v"]) for r in sample))[:n]
    out = np.zeros((len(chosen), dimensions), np.int64)
    for i, vector in enumerate(chosen):
        out[i, : len(vector)] = vector
    return out


def _numbers(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def _summarise(plan: Plan, dimensions: int, k: int):
    """Per task and cell: the nearest vectors' distances, and the queries' number and range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(plan.pivots)
        near: list[np.ndarray] = [np.empty(0)] * n
        count, low, high = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
        for batch in batches:
            vectors = matrix(batch.column("v"), dimensions)
            away = plan.distances(vectors, lifted=True)
            cell = away.argmin(axis=1)
            for c in np.unique(cell):
                near[c] = np.sort(np.concatenate([near[c], away[cell == c, c]]))[: k + 1]
            asked = _numbers(batch, "is_query").astype(bool)
            away = plan.distances(vectors[asked], lifted=False)
            cell = away.argmin(axis=1)
            own = away[np.arange(len(cell)), cell]
            np.add.at(count, cell, 1)
            np.minimum.at(low, cell, own)
            np.maximum.at(high, cell, own)
        rows = [("data", c, 1, float(d), float(d)) for c in range(n) for d in near[c]]
        rows += [("query", int(c), int(count[c]), low[c], high[c]) for c in np.flatnonzero(count)]
        names = ["kind", "cell", "n", "low", "high"]
        types = [pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _bounded(points: DataFrame, plan: Plan, dimensions: int, k: int, per_group: int) -> None:
    """Gather the summaries, ``k + 1`` distances and one row of queries per pivot."""
    summaries = points.select("is_query", "v").mapInArrow(
        _summarise(plan, dimensions, k), "kind string, cell int, n bigint, low double, high double"
    )
    by_cell = Window.partitionBy("kind", "cell").orderBy("low")
    data = summaries.where("kind = 'data'").withColumn("_place", F.row_number().over(by_cell))
    near = data.where(F.col("_place") <= k + 1).select("kind", "cell", "n", "low", "high")
    queries = (
        summaries.where("kind = 'query'")
        .groupBy("kind", "cell")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    )
    rows = near.unionByName(queries).collect()
    n = len(plan.pivots)
    count, low, high = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
    for r in rows:
        if r["kind"] == "query":
            count[r["cell"]], low[r["cell"]], high[r["cell"]] = r["n"], r["low"], r["high"]
    kept = [r for r in rows if r["kind"] == "data"]
    plan.bound(
        np.array([r["low"] for r in kept]),
        np.array([r["cell"] for r in kept], np.int64),
        low,
        high,
        count,
        k,
        per_group,
    )


def _needed(plan: Plan, dimensions: int):
    """Per task: how many vectors each group needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.zeros(plan.groups, np.int64)
        for batch in batches:
            away = plan.distances(matrix(batch.column("v"), dimensions), lifted=True)
            needed += plan.wanted(away).sum(axis=0)
        groups = np.flatnonzero(needed)
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.int64()), pa.array(needed[groups], pa.int64())], ["group", "n"]
        )

    return run


def _deal(plan: Plan, dimensions: int):
    """Each vector with the groups and slots it goes to, and each query with all of its group."""

    def out(batch, chosen, asks, lengths, group, slot) -> pa.RecordBatch:
        columns = [batch.column(c).filter(pa.array(chosen)) for c in ("row", "vec_id", "v")]
        flags = pa.array(np.full(len(lengths), asks))
        places = pa.StructArray.from_arrays(
            [pa.array(group, pa.int64()), pa.array(slot, pa.int64())], ["group", "slot"]
        )
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [*columns, flags, pa.ListArray.from_arrays(pa.array(offsets), places)],
            ["row", "vec_id", "v", "asks", "targets"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column("v"), dimensions)
            rows = _numbers(batch, "row")
            wanted = plan.wanted(plan.distances(vectors, lifted=True))
            sent = wanted.any(axis=1)
            at, group = np.nonzero(wanted[sent])
            slot = _spread(rows[sent][at], 1).astype(np.int64) % plan.slots[group]
            yield out(batch, sent, False, wanted[sent].sum(axis=1), group, slot)
            asked = _numbers(batch, "is_query").astype(bool)
            if asked.any():
                cell = plan.distances(vectors[asked], lifted=False).argmin(axis=1)
                part = _spread(rows[asked], 2).astype(np.int64) % plan.parts[cell]
                group = plan.first[cell] + part
                copies = plan.slots[group]
                begins = np.repeat(np.cumsum(copies) - copies, copies)
                slot = np.arange(copies.sum()) - begins
                yield out(batch, asked, True, copies, np.repeat(group, copies), slot)

    return run


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores of each row; of equal ones the leftmost."""
    rows, n = scores.shape
    if n <= k:
        return np.broadcast_to(np.arange(n), (rows, n))
    edge = np.partition(scores, n - k, axis=1)[:, n - k, None]
    above = scores > edge
    level = scores == edge
    level &= np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | level)[1].reshape(rows, k)


def _solve(dimensions: int, k: int):
    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        queries = group.filter(pa.array(asks))
        # In the order of ties.
        data = group.filter(pa.array(~asks)).sort_by([("vec_id", "ascending"), ("row", "ascending")])
        asked = matrix(queries.column("v").combine_chunks(), dimensions)
        vectors = matrix(data.column("v").combine_chunks(), dimensions)
        rows, ids = data.column("row").to_numpy(), data.column("vec_id").combine_chunks()
        own_rows, query_ids = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
        by_row = np.argsort(rows)
        largest = int(np.abs(asked).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * dimensions
        # Sums of products are exact in floating point up to 2^53.
        kind = np.float64 if largest < 1 << 53 else np.int64
        never = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        columns, asked = vectors.T.astype(kind), asked.astype(kind)
        step = max(1, CELLS // max(1, len(vectors)))
        found: list[tuple] = [(np.empty(0, np.int64),) * 4]
        for begin in range(0, len(asked) if len(vectors) else 0, step):
            scores = asked[begin : begin + step] @ columns
            own = own_rows[begin : begin + step]
            at = by_row[np.minimum(np.searchsorted(rows, own, sorter=by_row), len(rows) - 1)]
            met = rows[at] == own
            scores[np.flatnonzero(met), at[met]] = never
            place = best(scores, k)
            value = np.take_along_axis(scores, place, axis=1)
            who = np.broadcast_to(np.arange(begin, begin + len(scores))[:, None], place.shape)
            real = value != never
            found.append(
                (own_rows[who[real]], query_ids[who[real]], place[real], value[real].astype(np.int64))
            )
        own, query, place, value = (np.concatenate(c) for c in zip(*found))
        return pa.table(
            {
                "query_row": pa.array(own, pa.int64()),
                "query_id": pa.array(query, pa.int64()),
                "vec_id": ids.take(pa.array(place.astype(np.int64))),
                "row": pa.array(rows[place.astype(np.int64)], pa.int64()),
                "score": pa.array(value, pa.int64()),
            }
        )

    return run


_FOUND = "query_row bigint, query_id bigint, vec_id bigint, row bigint, score bigint"


def top_products(
    vectors: DataFrame,
    scratch: Scratch,
    *,
    k: int = 20,
    scale: int = 64,
    is_query: Column | None = None,
    queries_per_group: int = QUERIES_PER_GROUP,
    vectors_per_slot: int = VECTORS_PER_SLOT,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest products of each query.

    ``vectors`` has columns ``vec_id`` and ``embedding``; ``is_query`` is a condition on
    ``vec_id``, by default that 20 divides it.
    """
    if k < 1:
        raise ValueError("at least one neighbour must be asked for")
    importable(vectors.sparkSession)
    asked = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    points = scratch.keep(_points(vectors, asked, scale), "points")
    totals = points.agg(
        F.max("norm").alias("longest"),
        F.max(F.size("v")).alias("dimensions"),
        F.count_if("is_query").alias("queries"),
    ).first()
    if not totals["queries"]:
        return _ranked(points.sparkSession.createDataFrame([], _FOUND), k)
    dimensions = max(1, totals["dimensions"])
    n_pivots = min(MOST_PIVOTS, max(FEWEST_PIVOTS, totals["queries"] // QUERIES_PER_PIVOT))
    plan = Plan(_pivots(points, n_pivots, dimensions), totals["longest"])
    _bounded(points, plan, dimensions, k, queries_per_group)
    needed = points.select("v").mapInArrow(_needed(plan, dimensions), "group bigint, n bigint")
    plan.slots = np.ones(plan.groups, np.int64)
    for r in needed.groupBy("group").agg(F.sum("n").alias("n")).collect():
        plan.slots[r["group"]] = -(-r["n"] // vectors_per_slot)
    dealt = points.select("row", "vec_id", "is_query", "v").mapInArrow(
        _deal(plan, dimensions),
        "row bigint, vec_id bigint, v array<int>, asks boolean, "
        "targets array<struct<group: bigint, slot: bigint>>",
    )
    found = (
        dealt.select("row", "vec_id", "v", "asks", F.inline("targets"))
        .groupBy("group", "slot")
        .applyInArrow(_solve(dimensions, k), _FOUND)
    )
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(
        F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "row"
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
