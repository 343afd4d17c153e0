"""Connected components of an identifier graph.

Randomised contraction (Bögeholz, Brand and Todor, ICDE 2020): a round orders all vertices at
random, moves each to the first among itself and its neighbours, and goes on with the edges between
the vertices that are left. With a new order their number falls by a quarter at least in
expectation, whatever the graph's shape and labels, so all rounds together cost a few times the
first. An order serves two rounds: the first moves a hub to its first leaf, the second all others
there. Going back through the rounds gives every vertex its component, which is then named by its
smallest label.

The loop runs on pairs of integers: its aggregates keep fixed-width buffers in hash tables and its
shuffles carry sixteen bytes an edge. A key's integer is its hash, so edges need no join to get
theirs. When keys are joined back, once, their hashes are checked to differ; should two ever be alike,
all is done again with keys numbered in their order, as where edges have ends that are no vertices.
The smallest key of a component names it.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from citeloom.operators.lookup import ROWS_PER_TASK, hot_bound, hot_keys, lookup
from citeloom.operators.ordering import dense_index
from citeloom.scratch import Scratch


def star_edges(keys: str = "keys") -> list:
    """Select list giving ``src``/``dst`` from the first key of an array to each of the others."""
    rest = F.slice(F.col(keys), 2, F.greatest(F.size(keys) - 1, F.lit(0)))
    return [F.col(keys)[0].alias("src"), F.explode(rest).alias("dst")]


# Fixed value: the lower half of a long.
_HALF = (1 << 32) - 1


def _keys(step: int) -> list[int]:
    """Multipliers of a round and the next, below 31 bits so that no product leaves a long."""
    draw = random.Random(step // 2)
    return [draw.getrandbits(30) | 1 << 29 | 1 for _ in range(3)]


def _stirred(half: Column, key: int) -> Column:
    return F.shiftrightunsigned(half * F.lit(key), 17).bitwiseAND(F.lit(_HALF))


def _mixed(number: Column, step: int) -> Column:
    """A long for a long, one to one (a Feistel network), in an order that differs every other round."""
    left, right = F.shiftrightunsigned(number, 32), number.bitwiseAND(F.lit(_HALF))
    for key in _keys(step):
        left, right = right, left.bitwiseXOR(_stirred(right, key))
    return F.shiftleft(left, 32).bitwiseOR(right)


def _unmixed(mixed: Column, step: int) -> Column:
    """The long that :func:`_mixed` made this one of."""
    left, right = F.shiftrightunsigned(mixed, 32), mixed.bitwiseAND(F.lit(_HALF))
    for key in reversed(_keys(step)):
        left, right = right.bitwiseXOR(_stirred(left, key)), left
    return F.shiftleft(left, 32).bitwiseOR(right)


def parents(
    edges: DataFrame, scratch: Scratch | None = None, *, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``(id, component)`` for every vertex that is not its component's smallest label.

    ``edges`` has columns ``src`` and ``dst`` (integers) in either order and is read a few times, so
    it should be cheap to compute; copies do no harm. No record is ever joined to another on a
    shared identifier, so a hub costs its number of edges and no more.
    """
    scratch = scratch or Scratch(edges.sparkSession, "components")
    found = _grouped(edges, scratch, rows_per_task)
    lowest = found.groupBy("component").agg(F.min("id").alias("lowest"))
    hot = hot_keys(found, "component", total=found.count(), rows_per_task=rows_per_task)
    named = lookup(found, lowest, "component", how="inner", hot=hot, null_keys=False)
    return named.where("id <> lowest").select("id", F.col("lowest").alias("component"))


def _grouped(edges: DataFrame, scratch: Scratch, rows_per_task: int) -> DataFrame:
    """``(id, component)`` for every vertex with an edge to another, named by some vertex of it."""
    graph = edges.select(F.col("src").cast("bigint"), F.col("dst").cast("bigint")).where("src <> dst")

    step, sizes = 0, []
    while True:
        # One row per vertex that has an edge: where it moves, and its number of edges.
        ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
        both = graph.select(F.inline(ends).alias("id", "other"))
        first = both.select("id", _mixed(F.col("other"), step).alias("order")).groupBy("id").agg(
            F.min("order").alias("order"), F.count("order").alias("n")
        )
        first = first.select(
            "id", F.least("order", _mixed(F.col("id"), step)).alias("order"), "n"
        )
        moves = scratch.keep(
            first.select("id", _unmixed(F.col("order"), step).alias("component"), "n"), f"moves-{step}"
        )
        size = moves.agg(
            F.coalesce(F.max("n"), F.lit(0)).alias("most"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("ends"),
            F.count(F.lit(1)).alias("vertices"),
        ).first()
        if not size["vertices"]:
            break
        sizes.append(size["vertices"])
        hot = _hot_vertices(moves, size["most"], size["ends"], rows_per_task)
        moved = graph
        for end in ("src", "dst"):
            to = moves.select(F.col("id").alias(end), F.col("component").alias(f"new_{end}"))
            moved = lookup(moved, to, end, how="inner", hot=hot, null_keys=False).drop(end)
        left = moved.where("new_src <> new_dst").select(
            F.least("new_src", "new_dst").alias("src"), F.greatest("new_src", "new_dst").alias("dst")
        )
        graph = scratch.keep(left.distinct(), f"edges-{step + 1}")
        scratch.drop(f"edges-{step}")
        step += 1

    scratch.drop(f"edges-{step}")
    return _gathered(scratch, moves, sizes, rows_per_task)


def _hot_vertices(moves: DataFrame, most: int, ends: int, rows_per_task: int) -> list[tuple[int, int]]:
    """Vertices with many edges, known from the counts just taken."""
    if most <= rows_per_task:
        return []
    bound = hot_bound(ends, rows_per_task)
    rows = moves.where(F.col("n") > bound).select("id", "n").collect()
    return [(r["id"], -(-r["n"] // bound)) for r in rows]


def _gathered(
    scratch: Scratch, last: DataFrame, sizes: list[int], rows_per_task: int
) -> DataFrame:
    """Back through the rounds: each vertex goes where the one that it moved to went."""
    found = last.select("id", "component")
    for step in range(len(sizes) - 1, -1, -1):
        moves = scratch.table(f"moves-{step}").select("id", "component")
        hot = hot_keys(moves, "component", total=sizes[step], rows_per_task=rows_per_task)
        on = found.select(F.col("id").alias("component"), F.col("component").alias("further"))
        joined = lookup(moves, on, "component", hot=hot, null_keys=False)
        found = scratch.keep(
            joined.select("id", F.coalesce("further", "component").alias("component")), f"found-{step}"
        )
        scratch.drop(f"found-{step + 1}", f"moves-{step}")
    return found


def numbered_edges(
    edges: DataFrame,
    dictionary: DataFrame,
    total: int,
    scratch: Scratch,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Edges of string keys as edges of the keys' numbers; ends that have none are left out.

    ``total`` is the number of edges.
    """
    found = edges
    for end in ("src", "dst"):
        hot = hot_keys(edges, end, total=total, rows_per_task=rows_per_task)
        numbers = dictionary.select(F.col("id").alias(end), F.col("number").alias(f"{end}_number"))
        found = lookup(found, numbers, end, how="inner", hot=hot, null_keys=False).drop(end)
    kept = found.select(F.col("src_number").alias("src"), F.col("dst_number").alias("dst"))
    return scratch.keep(kept, "numbered-edges")


def components(
    vertices: DataFrame,
    edges: DataFrame,
    scratch: Scratch | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All columns of ``vertices`` (unique string column ``id``) plus ``component``.

    The component is the smallest id it holds; a vertex without edges is its own component. Edges
    run between vertices; those that do not are left out, at the price of a second run.
    """
    scratch = scratch or Scratch(vertices.sparkSession, "components")
    ends = edges.where("src <> dst").select(_label(F.col("src")).alias("src"), _label(F.col("dst")).alias("dst"))
    # In order, strings with one beginning lie together and take less room.
    ordered = scratch.keep(vertices.sortWithinPartitions("id"), "ordered-number")
    labelled = ordered.withColumn("number", _label(F.col("id")))
    placed = _placed(labelled, scratch.keep(ends, "pairs"), scratch, rows_per_task)
    if not placed.where("n > 1 OR known IS NULL").isEmpty():
        numbered = dense_index(vertices, ["id"], "number", scratch)
        pairs = numbered_edges(edges, numbered, edges.count(), scratch, rows_per_task)
        placed = _placed(numbered, pairs, scratch, rows_per_task)
    linked = placed.where(F.col("component").isNotNull())
    names = linked.groupBy("component").agg(F.min("id").alias("name"))
    hot = hot_keys(linked, "component", total=linked.count(), rows_per_task=rows_per_task)
    named = lookup(linked, names, "component", how="inner", hot=hot, null_keys=False)
    alone = placed.where(F.col("component").isNull()).withColumn("name", F.col("id"))
    both = named.select(*vertices.columns, "name").unionAll(alone.select(*vertices.columns, "name"))
    return both.withColumnRenamed("name", "component")


def _label(key: Column) -> Column:
    return F.xxhash64(key)


def _placed(numbered: DataFrame, pairs: DataFrame, scratch: Scratch, rows_per_task: int) -> DataFrame:
    """Vertices with the component of their number (null without edges) and ``n``, the vertices of
    that number, counted on the order that the join leaves. A number that only edges have gives a
    row with ``known`` null."""
    found = _grouped(pairs, scratch, rows_per_task).withColumnRenamed("id", "number")
    joined = numbered.withColumn("known", F.lit(True)).join(found, "number", "full")
    alike = Window.partitionBy("number")
    return scratch.keep(joined.withColumn("n", F.count(F.lit(1)).over(alike)).drop("number"), "placed-keys")
