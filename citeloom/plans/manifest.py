"""Run manifests, counters and sinks.

A manifest is a one-row DataFrame of fixed schema. It counts the errors and names the run's error
table, which holds every one of them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.metadata import METADATA_TYPE

ERROR_SCHEMA = "stage string, path string, line_no bigint, message string"

# Absent values are written as null, not left out; other formats pass this option over.
JSON_NULLS = {"ignoreNullFields": "false"}

FULLTEXT_RECORD = (
    "slug string, pmid string, pmcid string, doi string, text string, text_source string, "
    f"metadata {METADATA_TYPE}"
)

SEARCH_SCHEMA = (
    "source string, query string, start_date string, end_date string, result_count bigint, "
    "run_started_at string, retmax bigint"
)
RESOLVE_SCHEMA = (
    "input_file string, input_count bigint, unique_inputs bigint, record_count bigint, "
    "sources array<string>, error_count bigint, errors_path string, input_hash string, "
    "run_started_at string, records_path string"
)
MERGE_SCHEMA = (
    "input_files array<string>, input_hash string, record_count bigint, error_count bigint, "
    "errors_path string, run_started_at string, records_path string"
)
FULLTEXT_SCHEMA = (
    "input_files array<string>, input_hash string, record_count bigint, "
    "records_with_text bigint, records_without_text bigint, text_sources array<string>, "
    "metadata_sources array<string>, error_count bigint, errors_path string, "
    "run_started_at string, records_dir string"
)


def error_log(*parts: DataFrame) -> DataFrame:
    """Error rows of all stages in one schema: ``stage, path, line_no, message``."""
    spark = parts[0].sparkSession
    log = spark.createDataFrame([], ERROR_SCHEMA)
    for part in parts:
        log = log.unionByName(part, allowMissingColumns=True)
    return log.select("stage", "path", "line_no", "message")


def input_counts(ids: DataFrame) -> DataFrame:
    """``input_count, unique_inputs`` of ``kind, value`` rows.

    Distinct keys are counted after a map-side combine, so repeats do not travel.
    """
    grouped = ids.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    return grouped.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input_count"),
        F.count(F.lit(1)).alias("unique_inputs"),
    )


def text_counts(records: DataFrame, source: str = "text_source") -> DataFrame:
    """``record_count, records_with_text, records_without_text`` in one pass over ids."""
    return records.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count(source).alias("records_with_text"),
        F.count_if(F.col(source).isNull()).alias("records_without_text"),
    )


def sources_used(used: DataFrame, column: str = "source") -> DataFrame:
    """One row, ``sources``: the sorted set of source names (a handful)."""
    names = used.where(F.col(column).isNotNull()).select(F.col(column).alias("s")).distinct()
    return names.agg(F.sort_array(F.collect_list("s")).alias("sources"))


def one_row(spark: SparkSession, schema: str, values: dict) -> DataFrame:
    frame = spark.createDataFrame([], schema)
    return spark.createDataFrame([tuple(values.get(c) for c in frame.columns)], schema)


def write_manifest(manifest: DataFrame, run_dir: str) -> None:
    """``metadata.json`` folder with one JSON document, nulls written."""
    rows = manifest.select(F.to_json(F.struct("*"), JSON_NULLS))
    rows.coalesce(1).write.mode("overwrite").text(f"{run_dir}/metadata.json")


def read_manifest(spark: SparkSession, run_dir: str) -> dict:
    return json.loads(spark.read.text(f"{run_dir}/metadata.json").first()["value"])


class Counted:
    """Counters that are taken while a DataFrame is written, so nothing is read to count it."""

    def __init__(self, df: DataFrame, **counters: Column):
        self._seen = Observation()
        named = [c.alias(name) for name, c in counters.items()]
        self.df = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *named)

    def get(self) -> dict[str, int]:
        """The counters, once the DataFrame has been written."""
        return self._seen.get


def write_errors(errors: DataFrame, run_dir: str) -> int:
    """Write the run's error table; gives back the number of errors."""
    counted = Counted(errors)
    counted.df.write.mode("overwrite").parquet(errors_path(run_dir))
    return counted.get()["rows"]


def errors_path(run_dir: str) -> str:
    return f"{run_dir}/errors"


def write_id_list(ids: DataFrame, path: str, column: str = "pmid") -> int:
    """One identifier per line, in the DataFrame's order; gives back their number."""
    counted = Counted(ids.select(F.col(column).cast("string")))
    counted.df.write.mode("overwrite").text(path)
    return counted.get()["rows"]


def write_records(
    records: DataFrame, path: str, columns: Sequence[str] = ("pmid", "pmcid", "doi")
) -> int:
    """Compact JSON Lines; absent identifiers are written as null. Gives back their number."""
    counted = Counted(records.select(*columns))
    counted.df.write.mode("overwrite").options(**JSON_NULLS).json(path)
    return counted.get()["rows"]
