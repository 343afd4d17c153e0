"""Line sources: identifier lists and record JSON Lines, with bad rows kept as data.

Text is read once and lands in a columnar copy, whatever was made of a line beside its place
``(path, block, line_id)``: the file, the start of its input split, and its row in the copy, where
a split's lines stand together and in order. The place orders lines as they stand in the files, the
same in every later scan. Physical line numbers, wanted in error messages only, are the rows before
a line in its split and the lines of the splits before, a prefix sum over one row per split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citeloom.functions.identifiers import KINDS, strip
from citeloom.functions.jsontext import CORRUPT, is_single_value, parse_object, truthy
from citeloom.functions.once import evaluated
from citeloom.scratch import Scratch

PLACE = ["path", "block", "line_id"]

# Line ends beyond \n, \r and \r\n that identifier lists are also split on.
_MORE_LINE_ENDS = "[\\x0b\\x0c\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"

# Error texts of the two record readers.
MERGE_MISSING = "row has no recognizable identifiers"
FULLTEXT_MISSING = "record missing identifiers"


def _scan(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """``path, block, value`` of every physical line; the one place where text is read."""
    paths = [paths] if isinstance(paths, str) else sorted(paths)
    if not paths:
        raise ValueError("At least one JSONL file is required")
    return spark.read.text(paths).select(
        F.regexp_replace("_metadata.file_path", "^file:(//)?", "").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _landed(lines: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Write rows with ``path`` and ``block`` in the order they come; adds their ``line_id``.

    One task reads a split, so its lines are neighbours in one file of the copy.
    """
    others = [c for c in lines.columns if c not in PLACE]
    kept = scratch.keep(lines, name)
    return kept.select("path", "block", F.col("_metadata.row_index").alias("line_id"), *others)


def read_lines(
    spark: SparkSession, paths: Sequence[str] | str, scratch: Scratch | None = None
) -> DataFrame:
    """``path, block, line_id, value`` for every physical line, blank ones included."""
    return _landed(_scan(spark, paths), scratch or Scratch(spark, "lines"), "lines")


def line_offsets(lines: DataFrame) -> DataFrame:
    """First id and preceding line count of every split: one row per split, not per line."""
    splits = lines.groupBy("path", "block").agg(
        F.min("line_id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return splits.select(
        "path", "block", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
    )


def with_line_numbers(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """Add the 1-based ``line_no`` to rows taken from ``lines`` (usually the error rows only)."""
    numbered = rows.join(line_offsets(lines), ["path", "block"])
    return numbered.withColumn(
        "line_no", F.col("before") + F.col("line_id") - F.col("first_id") + 1
    ).drop("before", "first_id")


def identifier_list(
    spark: SparkSession, paths: Sequence[str] | str, scratch: Scratch | None = None
) -> DataFrame:
    """``pos, raw``: one identifier per line, stripped, blank lines dropped.

    ``pos`` is a struct that orders identifiers as they stand in the files.
    """
    pieces = _scan(spark, paths).select(
        "path", "block", F.explode(F.split("value", _MORE_LINE_ENDS)).alias("piece")
    )
    stripped = evaluated(pieces, "path", "block", strip(F.col("piece")).alias("raw"))
    ids = _landed(stripped.where(F.col("raw") != ""), scratch or Scratch(spark, "ids"), "ids")
    if ids.isEmpty():
        raise ValueError("Input file contains no identifiers")
    return ids.select(F.struct(*PLACE).alias("pos"), "raw")


def parse_records(
    lines: DataFrame, missing: str = MERGE_MISSING, value: str = "value"
) -> DataFrame:
    """Parse each non-blank line: adds ``pmid, pmcid, doi`` as text and ``error``.

    The three keys are kept, others ignored. ``error`` is null for a good line; a bad line has
    null identifiers.
    """
    kept = list(lines.columns)
    stripped = evaluated(lines, *kept, strip(F.col(value)).alias("_text"))
    return _parsed(stripped.where(F.col("_text") != ""), kept, missing)


def _parsed(stripped: DataFrame, kept: list[str], missing: str) -> DataFrame:
    """The columns kept, the three identifiers and the error of stripped texts."""
    text = F.col("_text")
    schema = ", ".join(f"{k} STRING" for k in KINDS)
    parsed = evaluated(
        stripped,
        *kept,
        "_text",
        parse_object(text, schema).alias("_parsed"),
        is_single_value(text).alias("_whole"),
    )
    is_object = text.startswith("{") & F.col("_whole") & F.col(f"_parsed.{CORRUPT}").isNull()
    any_present = _any([truthy(F.col(f"_parsed.{k}"), text, k) for k in KINDS])
    error = (
        F.when(is_object & any_present, F.lit(None).cast("string"))
        .when(is_object, F.lit(missing))
        .when(~text.startswith("{") & F.col("_whole"), F.lit("expected JSON object per line"))
        .otherwise(F.lit("invalid JSON"))
    )
    judged = evaluated(parsed, *kept, "_parsed", error.alias("error"))
    return judged.select(
        *kept,
        *[F.when(F.col("error").isNull(), F.col(f"_parsed.{k}")).alias(k) for k in KINDS],
        "error",
    )


def _any(flags: list[Column]) -> Column:
    combined = flags[0]
    for flag in flags[1:]:
        combined = combined | flag
    return combined


def read_records(
    spark: SparkSession,
    paths: Sequence[str] | str,
    missing: str = MERGE_MISSING,
    scratch: Scratch | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Records and error rows of JSON Lines files.

    Records: place columns and ``pmid, pmcid, doi`` as read. Errors: ``path, line_no, message``
    with the message in ``path:line: text`` form. Lines are read and parsed once.
    """
    scratch = scratch or Scratch(spark, "records")
    stripped = evaluated(
        _scan(spark, paths), "path", "block", strip(F.col("value")).alias("_text")
    )
    # Blank lines land too, as rows that are neither record nor error: they count as lines.
    blank = (F.col("_text") == "").alias("blank")
    parsed = _parsed(stripped.select("*", blank), ["path", "block", "blank"], missing)
    lines = _landed(parsed, scratch, "parsed-lines")
    given = lines.where(~F.col("blank"))
    records = given.where(F.col("error").isNull()).select(*PLACE, *KINDS)
    bad = given.where(F.col("error").isNotNull()).select(*PLACE, "error")
    errors = with_line_numbers(bad, lines).select(
        "path",
        "line_no",
        F.concat_ws("", "path", F.lit(":"), "line_no", F.lit(": "), "error").alias("message"),
    )
    return records, errors


def dedup_triples(records: DataFrame, place: Sequence[str] = PLACE) -> DataFrame:
    """One row per exact ``(pmid, pmcid, doi)`` as read, at the place it first appears.

    Nulls are equal to each other. Copies of one triple combine map-side.
    """
    first = records.groupBy(*KINDS).agg(F.min(F.struct(*place)).alias("_first"))
    return first.select(*[F.col(f"_first.{p}").alias(p) for p in place], *KINDS)
