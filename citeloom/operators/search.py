"""Search a corpus table by predicate and inclusive publication dates.

A corpus that is searched often is laid out by publication month once (:func:`lay_out`); date bounds
then choose folders before anything is read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.dates import parse_date_option


# The partition column of a laid-out corpus; documents without a date are in a folder of their own.
MONTH = "pub_month"


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def lay_out(corpus: DataFrame, path: str, date_column: str = "pub_date") -> None:
    """Write a corpus in folders by month.

    Rows are dealt by ranges of month and hash, so a month with very many documents is several
    tasks and files, and a month with few is one.
    """
    hashed = F.xxhash64(*[c for c, t in corpus.dtypes if "map<" not in t and t != "variant"])
    months = corpus.withColumn(MONTH, _month(F.col(date_column)))
    dealt = months.repartitionByRange(MONTH, hashed).sortWithinPartitions(MONTH, date_column)
    dealt.write.mode("overwrite").partitionBy(MONTH).parquet(path)


def laid_out(spark: SparkSession, path: str) -> DataFrame:
    """A corpus written by :func:`lay_out`."""
    return spark.read.option("inferSchema", "false").parquet(path).withColumn(
        MONTH, F.col(MONTH).cast("string")
    )


def contains(term: str, column: str = "text") -> Column:
    """Default predicate: the column holds the term."""
    return F.col(column).contains(term)


def search(
    corpus: DataFrame,
    predicate: Column,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    date_column: str = "pub_date",
) -> DataFrame:
    """Rows that meet the predicate, published from ``start`` to ``end``; either may be open.

    Plain comparisons, so they reach the scan; in a laid-out corpus the months are bounded too.
    """
    start = parse_date_option("start-date", start)
    end = parse_date_option("end-date", end)
    found = corpus.where(predicate)
    by_month = MONTH in corpus.columns
    if start is not None:
        found = found.where(F.col(date_column) >= F.lit(start))
        if by_month:
            found = found.where(F.col(MONTH) >= start.strftime("%Y-%m"))
    if end is not None:
        found = found.where(F.col(date_column) <= F.lit(end))
        if by_month:
            found = found.where(F.col(MONTH) <= end.strftime("%Y-%m"))
    return found
