"""Merge records that share identifiers, directly or through other records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.identifiers import key_kind, key_value, sort_token
from citeloom.operators.components import components, star_edges
from citeloom.operators.lookup import ROWS_PER_TASK, hot_keys, lookup
from citeloom.operators.records import identifier_errors, record_keys, widen
from citeloom.scratch import Scratch
from citeloom.sources.lines import MERGE_MISSING, read_records


@dataclass(frozen=True)
class MergeResult:
    """``records`` (pmid, pmcid, doi), ``members`` (id, kind, value, component) and ``errors``
    (stage, path, line_no, message)."""

    records: DataFrame
    members: DataFrame
    errors: DataFrame
    scratch: Scratch


def grouped_members(
    records: DataFrame, scratch: Scratch, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``id, kind, value, component`` for every distinct valid identifier of the records."""
    before = scratch.tables()
    # No filter on the list: it would be pushed below and work the keys out a second time.
    keys = records.select(record_keys().alias("keys")).distinct()
    # Distinct key lists: read by both the vertex and the edge scan below.
    keys = scratch.keep(keys, "keys")
    vertices = keys.select(F.explode("keys").alias("id")).distinct()
    edges = keys.where(F.size("keys") > 1).select(*star_edges())
    found = components(vertices, edges, scratch, rows_per_task=rows_per_task)
    members = found.select(
        "id",
        key_kind(F.col("id")).alias("kind"),
        key_value(F.col("id")).alias("value"),
        "component",
    )
    members = scratch.keep(members, "members")
    scratch.drop_since(before, keep=("members",))
    return members


def merged_records(members: DataFrame) -> DataFrame:
    """One record per component with the smallest value (as text) of each kind."""
    return widen(members, "component").drop("component")


def in_output_order(records: DataFrame) -> DataFrame:
    """Sort by the first identifier present, as ``kind:value`` text."""
    return records.orderBy(sort_token(F.col("pmid"), F.col("pmcid"), F.col("doi")))


def conflicts(members: DataFrame) -> DataFrame:
    """``component, kind, n``: kinds that hold more than one value in a component."""
    counted = members.groupBy("component", "kind").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def _quoted(value: Column) -> Column:
    """A value as it is quoted in a conflict list."""
    escaped = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    apostrophe, double = value.contains("'"), value.contains('"')
    return (
        F.when(apostrophe & ~double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .when(apostrophe, F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
        .otherwise(F.concat(F.lit("'"), escaped, F.lit("'")))
    )


def conflict_values(
    members: DataFrame, *, rows_per_task: int = ROWS_PER_TASK, total: int | None = None
) -> DataFrame:
    """``component, kind, value, chosen``: every value that is not the one its record keeps."""
    group = F.concat_ws(" ", "kind", "component")
    counted = members.groupBy("component", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("chosen")
    )
    disputed = counted.where(F.col("n") > 1).select(group.alias("group"), "chosen")
    # The group names both kind and component; a kind has no space.
    facts = members.select(group.alias("group"), "value")
    hot = hot_keys(facts, "group", total=total, rows_per_task=rows_per_task)
    listed = lookup(facts, disputed, "group", how="inner", hot=hot, null_keys=False)
    return listed.where(F.col("value") != F.col("chosen")).select(
        F.expr("substring(group, locate(' ', group) + 1)").alias("component"),
        F.substring_index("group", " ", 1).alias("kind"),
        "value",
        "chosen",
    )


def conflict_messages(
    members: DataFrame, *, rows_per_task: int = ROWS_PER_TASK, total: int | None = None
) -> DataFrame:
    """``component, kind, message``: each value beside the one its record keeps.

    One row per value at every size, so no group is gathered.
    """
    rows = conflict_values(members, rows_per_task=rows_per_task, total=total)
    text = F.concat(
        F.lit("Conflicting "),
        F.col("kind"),
        F.lit(" values encountered: ["),
        _quoted(F.col("chosen")),
        F.lit(", "),
        _quoted(F.col("value")),
        F.lit("]"),
    )
    return rows.select("component", "kind", text.alias("message"))


def merge(
    records: DataFrame,
    scratch: Scratch | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> MergeResult:
    """Merge records with columns ``pmid, pmcid, doi`` (and optionally ``path``)."""
    scratch = scratch or Scratch(records.sparkSession, "merge")
    members = grouped_members(records, scratch, rows_per_task)
    path = F.col("path") if "path" in records.columns else F.lit(None).cast("string")
    bad = identifier_errors(records).select(
        F.lit("normalize").alias("stage"),
        path.alias("path"),
        F.lit(None).cast("bigint").alias("line_no"),
        F.concat_ws(": ", path, F.col("message")).alias("message"),
    )
    disputed = conflict_messages(
        members,
        rows_per_task=rows_per_task,
        total=members.count(),
    ).select(
        F.lit("merge").alias("stage"),
        F.lit(None).cast("string").alias("path"),
        F.lit(None).cast("bigint").alias("line_no"),
        "message",
    )
    return MergeResult(merged_records(members), members, bad.unionByName(disputed), scratch)


def merge_paths(
    spark: SparkSession, paths: Sequence[str], scratch: Scratch | None = None, **options
) -> MergeResult:
    """Merge JSON Lines files; parse errors carry their path and line number."""
    if not paths:
        raise ValueError("At least one JSONL file is required")
    scratch = scratch or Scratch(spark, "merge")
    records, parse_errors = read_records(spark, paths, MERGE_MISSING, scratch)
    result = merge(records, scratch, **options)
    read = parse_errors.select(F.lit("read").alias("stage"), "path", "line_no", "message")
    return MergeResult(
        result.records, result.members, read.unionByName(result.errors), scratch
    )
