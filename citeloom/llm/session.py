"""What the operators of this subpackage need from a session."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.scratch import Scratch

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    On a cluster the package is shipped in the usual way (``--py-files``); this only adds a path.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])


# One operator's tables at a time: a Python worker serves one stage after another.
_held: dict[tuple, object] = {}


def in_worker(*key, make: Callable[[], object]):
    """What a worker keeps between tasks; asking for something else lets go of it first."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, null text as the empty one; other columns are not read."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the DataFrame does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def addressed(df: DataFrame, scratch: Scratch) -> tuple[DataFrame, str, str]:
    """The DataFrame with each row's file and number there, and these columns' names.

    A table is addressed where it lies; anything else is written first.
    """
    file, row = unused(df, "_file"), unused(df, "_row")
    place = [F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)]
    try:
        return df.select("*", *place), file, row
    except AnalysisException:
        return scratch.keep(df, "addressed").select("*", *place), file, row


def file_bytes(path: str) -> bytes:
    """A vocabulary file, read by the driver; its size is fixed, so it may be broadcast."""
    with open(path, "rb") as handle:
        return handle.read()


def folder_address(scratch: Scratch, name: str) -> str:
    """The full address of one of a run's folders, for tasks that open its files themselves."""
    spark = scratch.spark
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch.path}/{name}")
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", full)
