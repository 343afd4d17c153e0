"""Dense positions, neighbours and pages over a global order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from citeloom.scratch import Scratch

# Neighbouring rows that one task compares.
RUN = 100_000


def dense_index(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "position",
    scratch: Scratch | None = None,
) -> DataFrame:
    """Number rows 0, 1, 2, … by a unique order.

    The rows are range-sorted into a scratch table, whose files follow the order. A row's number
    is its place in its file plus the rows in the files before: the only thing gathered is one
    count per file.
    """
    scratch = scratch or Scratch(df.sparkSession, "order")
    table = f"ordered-{name}"
    ordered = scratch.keep(df.orderBy(*order), table)
    placed = ordered.select(
        "*",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    counts = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()

    def place(file: str) -> tuple[int, str]:
        return int(file.split("-")[1]), file

    offsets, before = [], 0
    for row in sorted(counts, key=lambda r: place(r["_file"])):
        offsets.append((row["_file"], before))
        before += row["n"]
    starts = df.sparkSession.createDataFrame(offsets, "_file string, _before bigint")
    return (
        placed.join(F.broadcast(starts), "_file")
        .withColumn(name, F.col("_before") + F.col("_row"))
        .drop("_file", "_row", "_before")
    )


def with_previous(
    indexed: DataFrame, columns: Sequence[str], position: str = "position", run: int = RUN
) -> DataFrame:
    """Add ``previous_<column>`` of the row before, over dense positions.

    Rows are dealt in runs of fixed length, whatever their keys, and the last row of each run is
    also given to the next one, which needs it as predecessor only.
    """
    own = F.floor(F.col(position) / run)
    last = F.col(position) % run == run - 1
    dealt = indexed.select(
        "*", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))).alias("_run")
    )
    order = Window.partitionBy("_run").orderBy(position)
    seen = dealt.select("*", *[F.lag(c).over(order).alias(f"previous_{c}") for c in columns])
    return seen.where(F.col("_run") == own).drop("_run")


def paged(df: DataFrame, page_size: int, position: str = "position") -> DataFrame:
    """Add the page number of every row of an indexed DataFrame."""
    if page_size < 1:
        raise ValueError("page size must be at least 1")
    return df.withColumn("page", F.floor(F.col(position) / F.lit(page_size)).cast("bigint"))


def one_page(
    df: DataFrame, retstart: int, retmax: int, position: str = "position"
) -> DataFrame:
    """Rows ``retstart`` to ``retstart + retmax - 1`` of an indexed DataFrame."""
    if retmax < 1:
        raise ValueError("page size must be at least 1")
    return df.where(F.col(position).between(retstart, retstart + retmax - 1))
