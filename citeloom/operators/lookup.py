"""Equi-joins against keyed tables that hold up under hot keys and null keys.

Facts may repeat a key any number of times; the table looked up has one row per key. A hot key
is spread over several tasks by a slot number, and the one matching row is copied once per slot.
Rows with a null key match nothing; without care they would all hash to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fact rows of one key that a single task is asked to handle.
ROWS_PER_TASK = 1_000_000
# A hot key holds at least this part of all rows, so there are never more hot keys than this and
# broadcasting the table of them is safe.
MAX_HOT_KEYS = 100_000
_NULL_SLOTS = 65_536
# Groups of keys that are counted before single keys: this many, or, where the bound on a key is low,
# so many that a group without a hot key seldom exceeds it.
_KEY_GROUPS, _MOST_KEY_GROUPS = 4_096, 524_288
# Key sets up to this many rows (a few MB) are broadcast to prune the table they are looked up in.
BROADCAST_KEYS = 100_000

HotKeys = list[tuple[str | int, int]]


def hot_keys(
    facts: DataFrame, key: str, *, total: int | None = None, rows_per_task: int = ROWS_PER_TASK
) -> HotKeys:
    """``(key, slots)`` for every key holding more rows than one task should handle.

    That is ``rows_per_task`` or, in tables so large that more keys than ``MAX_HOT_KEYS`` could
    exceed it, that share of all rows. Counts are exact: groups of keys are counted first, which
    shuffles a number a group and task, then the single keys of those groups that exceed the bound,
    since no other can hold a hot key. With a total that no key can exceed, nothing is run.
    """
    if total is None:
        total = facts.where(F.col(key).isNotNull()).count()
    if total <= rows_per_task:
        return []
    bound = hot_bound(total, rows_per_task)
    groups = min(max(_KEY_GROUPS, 4 * total // bound), _MOST_KEY_GROUPS)
    rows = facts.where(F.col(key).isNotNull()).select(
        key, F.pmod(F.xxhash64(key), F.lit(groups)).alias("_group")
    )
    large = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound)
    found = [(r["_group"],) for r in large.select("_group").collect()]
    if not found:
        return []
    held = F.broadcast(facts.sparkSession.createDataFrame(found, "_group bigint"))
    suspects = rows.join(held, "_group", "left_semi")
    counted = suspects.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return [(r[key], -(-r["_n"] // bound)) for r in counted.where(F.col("_n") > bound).collect()]


def hot_bound(total: int, rows_per_task: int) -> int:
    """Rows of one key above which it is spread; fewer keys than ``MAX_HOT_KEYS`` exceed it."""
    return max(rows_per_task, total // MAX_HOT_KEYS)


def prune(table: DataFrame, keys: DataFrame, key: str, bound: int) -> DataFrame:
    """Table rows whose key is wanted, where the wanted keys are few enough to broadcast.

    ``bound`` is a checked upper limit on the rows of ``keys``. With more keys the table comes
    back as it is, for the join that follows to sort out.
    """
    if bound > BROADCAST_KEYS:
        return table
    return table.join(F.broadcast(keys.select(key)), key, "left_semi")


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    *,
    how: str = "left",
    hot: Sequence[tuple[str | int, int]] = (),
    null_keys: bool = True,
    pick: str | None = None,
) -> DataFrame:
    """Join ``facts`` to ``table``, which has one row per key; both name the key column alike.

    ``hot`` comes from :func:`hot_keys`; ``null_keys=False`` says the facts' keys are never
    null, which keeps a plain one-column join that can reuse an existing partitioning. Where the
    table may repeat keys, ``pick`` names its one other column, whose smallest value is taken;
    copies combine map-side, and the join that follows reuses the grouping's partitioning.
    """
    if not hot and not null_keys:
        return facts.join(_one_per_key(table, [key], pick), key, how)

    slots = F.lit(1)
    if hot:
        table = _one_per_key(table, [key], pick)
        spark = facts.sparkSession
        kind = facts.schema[key].dataType.simpleString()
        spread = F.broadcast(spark.createDataFrame(list(hot), f"`{key}` {kind}, _slots int"))
        facts = facts.join(spread, key, "left")
        table = table.join(spread, key, "left").withColumn(
            "_slot", F.explode(F.sequence(F.lit(0), F.coalesce("_slots", F.lit(1)) - 1))
        ).drop("_slots")
        slots = F.coalesce("_slots", F.lit(1))
    else:
        # Computed rather than a literal 0: a literal would be folded out of the join keys.
        table = table.withColumn(
            "_slot", F.pmod(F.xxhash64(key), F.lit(1)).cast("int")
        )
        table = _one_per_key(table, [key, "_slot"], pick)

    row_hash = F.xxhash64(*[c for c, t in facts.dtypes if "map<" not in t and t != "variant"])
    slot = F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(_NULL_SLOTS))).otherwise(
        F.pmod(row_hash, slots) if hot else F.lit(0)
    )
    facts = facts.withColumn("_slot", slot.cast("int")).drop("_slots")
    return facts.join(table, [key, "_slot"], how).drop("_slot")


def _one_per_key(table: DataFrame, keys: list[str], pick: str | None) -> DataFrame:
    if pick is None:
        return table
    return table.groupBy(*keys).agg(F.min(pick).alias(pick))
