"""Records to identifiers and back: explode, discard reports, first-occurrence dedup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.identifiers import (
    KINDS,
    compact,
    identifier_error,
    identifier_key,
    key_kind,
    key_value,
    kind_value,
    strip,
)

# Fixed value: the message for a record left without identifiers.
DISCARDED = "record discarded after normalization due to missing identifiers"


def record_keys() -> Column:
    """Distinct keys of a record's valid identifiers in key order."""
    return compact(*[identifier_key(F.col(k)) for k in KINDS])


def explode_identifiers(records: DataFrame) -> DataFrame:
    """One row per valid identifier: the record's other columns, ``kind``, ``value``.

    The value decides the kind: a number under the ``pmcid`` key is a PMID.
    """
    others = [c for c in records.columns if c not in KINDS]
    keys = F.array(*[identifier_key(F.col(k)) for k in KINDS])
    exploded = records.select(*others, F.explode(keys).alias("id")).where(F.col("id").isNotNull())
    return exploded.select(
        *others, key_kind(F.col("id")).alias("kind"), key_value(F.col("id")).alias("value")
    )


def identifier_errors(records: DataFrame) -> DataFrame:
    """Two kinds of error rows: one per bad value, one more per record left with no identifier.

    Keeps the columns other than the three keys and adds ``message`` (without a path).
    """
    others = [c for c in records.columns if c not in KINDS]

    def bad(value: Column) -> Column:
        given = value.isNotNull() & (strip(value) != "")
        return F.when(given & identifier_key(value).isNull(), identifier_error(value))

    discarded = F.when(F.size(record_keys()) == 0, F.lit(DISCARDED))
    messages = F.array_compact(F.array(*[bad(F.col(k)) for k in KINDS], discarded))
    return records.select(*others, F.explode(messages).alias("message"))


def discarded_records(records: DataFrame) -> DataFrame:
    """Records without a single valid identifier."""
    return records.where(F.size(record_keys()) == 0)


def dedup_identifiers(ids: DataFrame, position: str = "pos") -> DataFrame:
    """``kind, value, pos``: each identifier once, at its first position."""
    return ids.groupBy("kind", "value").agg(F.min(position).alias(position))


def widen(members: DataFrame, group: str, value: Column | None = None) -> DataFrame:
    """Long to wide: per group the smallest value of each kind, absent kinds null.

    Conditional aggregates combine map-side, so a group of any size is one row per task.
    """
    value = F.col("value") if value is None else value
    return members.groupBy(group).agg(
        *[F.min(kind_value(F.col("kind"), value, k)).alias(k) for k in KINDS]
    )
