"""Contiguous shards of the smallest possible largest size.

Equal texts form a group that stays whole; groups stand in the order of their text's digest. For
a capacity, shards are filled greedily: each takes groups while they fit. The smallest capacity
that needs no more shards than asked for is found by binary search, and the cuts are made there.

Filling greedily needs the running size of the groups, so it is worked out once, by stretches of
the digest order: sizes within a stretch, plus what all stretches before hold. A greedy step is
then "the largest running size within reach", an aggregate over the part of the table that may
hold it. The steps for all capacities of several halvings are asked together.

Cases: null text has no bytes and stands with the empty one; rows with the same text are one
group, in the order of their ids and then as numbered; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from citeloom.operators.ordering import dense_index
from citeloom.scratch import Scratch

# Halvings whose capacities are checked in one job.
LEVELS = 4
# Groups in a stretch of the digest order, about.
STRETCH = 100_000


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id, size, text_crc32, digest`` of every document; no text goes further."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
    )


def _stretch(n: int) -> Column:
    """Which of ``n`` equal parts of the digest's range a digest is in; follows its order."""
    lead = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    return F.shiftright(lead * F.lit(n), 32).cast("int")


def running_sizes(sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """``digest, through``: the size of all groups up to and with this one; kept as a table."""
    groups = scratch.keep(
        sizes.groupBy("digest").agg(F.sum("size").alias("size")), "groups"
    )
    n = max(1, min(1 << 31, groups.count() // STRETCH))
    placed = groups.withColumn("stretch", _stretch(n))
    # One row per stretch, far fewer than groups.
    totals = placed.groupBy("stretch").agg(F.sum("size").alias("total"))
    earlier = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        "stretch", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before")
    )
    within = F.sum("size").over(Window.partitionBy("stretch").orderBy("digest"))
    return scratch.keep(
        placed.withColumn("within", within)
        .join(before, "stretch")
        .select("digest", (F.col("before") + F.col("within")).alias("through"), "size"),
        "running",
    )


def _furthest(running: DataFrame, reaches: list[int], largest: int) -> list[int]:
    """For each reach the largest running size within it; ``largest`` bounds any group.

    Running sizes lie no further apart than the largest group, which says where to look.
    """
    wanted = sorted(set(reaches))
    looked = running.where(
        F.col("through").between(wanted[0] - largest, wanted[-1])
    ).agg(
        *[
            F.max(F.when(F.col("through") <= reach, F.col("through"))).alias(f"r{i}")
            for i, reach in enumerate(wanted)
        ]
    )
    row = looked.first()
    found = {reach: row[i] for i, reach in enumerate(wanted)}
    return [found[reach] if found[reach] is not None else 0 for reach in reaches]


def _fill(running: DataFrame, capacities: list[int], shards: int, total: int, largest: int) -> list[list[int]]:
    """The cuts of a greedy filling for each capacity, all capacities a step at a time."""
    cuts: list[list[int]] = [[] for _ in capacities]
    for _ in range(shards):
        open_ = [i for i, c in enumerate(cuts) if not c or c[-1] < total]
        if not open_:
            break
        reaches = [min(total, (cuts[i][-1] if cuts[i] else 0) + capacities[i]) for i in open_]
        for i, cut in zip(open_, _furthest(running, reaches, largest)):
            cuts[i].append(cut)
    return cuts


def smallest_capacity(running: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the running sizes at which its shards end."""
    row = running.agg(F.max("through").alias("total"), F.max("size").alias("largest")).first()
    total, largest = row["total"] or 0, row["largest"] or 0
    if not total:
        return 0, []
    # Below the first bound it cannot be; a share of the total plus one group always suffices.
    low = max(largest, -(-total // shards))
    high = -(-total // shards) + largest
    best = _fill(running, [high], shards, total, largest)[0]
    while low < high:
        step = max(1, (high - low) >> LEVELS)
        tried = sorted({c for c in range(low, high, step)})
        filled = _fill(running, tried, shards, total, largest)
        feasible = [i for i, cuts in enumerate(filled) if cuts[-1] == total]
        if not feasible:
            low = tried[-1] + 1
            continue
        first = feasible[0]
        high, best = tried[first], filled[first]
        if first:
            low = tried[first - 1] + 1
        else:
            low = high
    return high, best


def minimax_shards(docs: DataFrame, shards: int, scratch: Scratch) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    sizes = scratch.keep(sized(docs), "sizes")
    running = running_sizes(sizes, scratch)
    _, cuts = smallest_capacity(running, shards)
    # A shard ends with the group whose running size is its cut: at most `shards` digests.
    ends = [
        r["digest"]
        for r in running.where(F.col("through").isin(cuts[:-1])).orderBy("digest").collect()
    ]
    shard = sum(((F.col("digest") > F.lit(end)).cast("int") for end in ends), F.lit(0))
    placed = dense_index(sizes, ["digest", "doc_id", "size"], "position", scratch)
    placed = placed.withColumn("shard", shard.cast("int"))
    # One row per shard: where it begins.
    counts = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    begins = F.lit(0).cast("long")
    before = 0
    for number in range(shards):
        begins = F.when(F.col("shard") == number, F.lit(before).cast("long")).otherwise(begins)
        before += counts.get(number, 0)
    return placed.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("position") - begins).alias("slot")
    )
