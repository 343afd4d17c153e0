"""Full text and metadata for records from prioritized provider tables.

A provider's texts land once in a columnar copy, cleaned if they are computed, each with its digest;
from then on a text is known by its place there, a file and a row. Which provider serves a record,
and with which of several texts of a key, is settled on keys, digests and places, so error reports,
counts and metadata never move text. At the end each record fetches its text by place: no text is
aggregated, compared or shuffled before that, and only texts that are wanted are shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.identifiers import KINDS
from citeloom.functions.metadata import METADATA_TYPE
from citeloom.functions.once import evaluated
from citeloom.operators.lookup import HotKeys, hot_keys, lookup, prune
from citeloom.scratch import Scratch

# Rows with text are large, so fewer of one key go to a task than where only ids move.
TEXT_ROWS_PER_TASK = 50_000


# Characters of a text that order the texts of one key, before their digests do.
_LEAD = 64


@dataclass(frozen=True)
class TextProvider:
    """``table`` has ``key, text``; ``kind`` is the identifier looked up.

    ``miss`` is the message for a key without text, with ``{}`` for the key. Where the table
    repeats a key, the text that begins smallest is taken, among those the one with the smallest
    digest. A landed provider's table has ``key, text, rank`` with texts that are not empty, and
    ``rank`` says their order and, last, their ``place``.
    """

    name: str
    kind: str
    table: DataFrame
    miss: str
    landed: bool = False


@dataclass(frozen=True)
class MetadataProvider:
    """``table`` has ``key, metadata``; ``kinds`` are the identifiers tried, in order.

    Where the table repeats a key, as when a response was landed twice, one answer is taken.
    """

    name: str
    table: DataFrame
    kinds: tuple[str, ...]


# Provider names and messages as they appear in results.
def pubget(table: DataFrame) -> TextProvider:
    return TextProvider("pubget", "pmcid", table, "PubGet returned no text for {}")


def ace(table: DataFrame) -> TextProvider:
    return TextProvider("ace", "pmid", table, "ACE returned no text for PMID {}")


def _hot(records: DataFrame, kind: str, total: int, rows_per_task: int) -> HotKeys:
    return hot_keys(records, kind, total=total, rows_per_task=rows_per_task)


def _pruned(table: DataFrame, records: DataFrame, kind: str, total: int) -> DataFrame:
    """Provider rows for the records' keys, when those are few; before any text is cleaned."""
    return prune(table, records.select(F.col(kind).alias("key")), "key", total)


def _texts(provider: TextProvider, records: DataFrame, total: int) -> DataFrame:
    """``key, text, lead, digest``: texts of the records' keys, computed once."""
    table = _pruned(provider.table, records, provider.kind, total).where(F.col("key").isNotNull())
    found = evaluated(table, "key", "text").where(F.col("text") != "")
    return found.select(
        "key", "text", F.substring("text", 1, _LEAD).alias("lead"), F.sha2("text", 256).alias("digest")
    )


def land(
    provider: TextProvider, records: DataFrame, scratch: Scratch, *, total: int | None = None
) -> TextProvider:
    """The provider with its texts kept as a table and each text's place there known.

    Cleaning and digests are worked out here and nowhere else.
    """
    if provider.landed:
        return provider
    total = records.count() if total is None else total
    kept = scratch.keep(_texts(provider, records, total), f"texts-{provider.name}")
    place = F.concat_ws("#", F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    rank = F.struct("lead", "digest", place.alias("place"))
    return replace(provider, table=kept.select("key", "text", rank.alias("rank")), landed=True)


def _ranked(provider: TextProvider, records: DataFrame, total: int) -> DataFrame:
    """``key, rank`` of a provider's texts; without a place where they have not landed."""
    if provider.landed:
        return provider.table.select("key", "rank")
    nowhere = F.lit(None).cast("string").alias("place")
    texts = _texts(provider, records, total)
    return texts.select("key", F.struct("lead", "digest", nowhere).alias("rank"))


def choose_text_source(
    records: DataFrame,
    providers: Sequence[TextProvider],
    *,
    rows_per_task: int = TEXT_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``text_source``, ``text_place`` and ``misses`` (messages of providers tried in vain).

    Providers are tried in order until one has text; a record without the provider's kind of
    identifier passes it silently. Records need no unique key. Places are known of providers that
    have landed (:func:`land`).
    """
    total = records.count()

    def null(name: str) -> Column:
        return F.lit(None).cast("string").alias(name)

    chosen = records.select(
        "*", null("text_source"), null("text_place"), F.array().cast("array<string>").alias("misses")
    )
    for provider in providers:
        # A record already served, or with an empty id, has nothing to look up.
        wanted = F.when(F.col("text_source").isNull(), F.nullif(provider.kind, F.lit("")))
        keys = _ranked(provider, records, total).select(
            F.col("key").alias("_key"), F.col("rank").alias("_rank")
        )
        hot = _hot(records, provider.kind, total, rows_per_task)
        looked = lookup(chosen.withColumn("_key", wanted), keys, "_key", hot=hot, pick="_rank")
        before, after = provider.miss.split("{}")
        found = F.col("_rank").isNotNull()
        missed = F.col("_key").isNotNull() & ~found
        message = F.concat(F.lit(before), F.col("_key"), F.lit(after))
        chosen = looked.select(
            *records.columns,
            F.when(found, F.lit(provider.name))
            .otherwise(F.col("text_source"))
            .alias("text_source"),
            F.coalesce("text_place", "_rank.place").alias("text_place"),
            F.when(missed, F.array_append("misses", message)).otherwise(F.col("misses")).alias("misses"),
        )
    return chosen


def text_errors(chosen: DataFrame) -> DataFrame:
    """One row per provider tried in vain, also where a later provider had text."""
    others = [c for c in chosen.columns if c not in ("misses", "text_source", "text_place")]
    return chosen.select(*others, F.explode("misses").alias("message"))


def without_text(chosen: DataFrame) -> DataFrame:
    """Records no provider has text for."""
    return chosen.where(F.col("text_source").isNull())


def attach_metadata(
    chosen: DataFrame,
    providers: Sequence[MetadataProvider],
    *,
    rows_per_task: int = TEXT_ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """Add ``metadata`` to records that have text; the first provider's whole answer is taken."""
    total = chosen.count() if total is None else total
    found = chosen.withColumn("metadata", F.lit(None).cast(METADATA_TYPE))
    for provider in providers:
        for kind in provider.kinds:
            table = _pruned(provider.table, chosen, kind, total).select(
                F.col("key").alias("_key"), F.col("metadata").alias("_metadata_found")
            )
            wanted = F.when(
                F.col("text_source").isNotNull() & F.col("metadata").isNull(),
                F.nullif(kind, F.lit("")),
            )
            hot = _hot(chosen, kind, total, rows_per_task)
            looked = lookup(
                found.withColumn("_key", wanted), table, "_key", hot=hot, pick="_metadata_found"
            )
            found = looked.withColumn(
                "metadata", F.coalesce("metadata", "_metadata_found")
            ).drop("_key", "_metadata_found")
    return found


def attach_text(
    chosen: DataFrame,
    providers: Sequence[TextProvider],
    *,
    rows_per_task: int = TEXT_ROWS_PER_TASK,
    total: int | None = None,
) -> DataFrame:
    """Add ``text``, fetched from the landed providers by the places the records were given."""
    total = chosen.count() if total is None else total
    parts = [without_text(chosen).withColumn("text", F.lit(None).cast("string"))]
    for provider in providers:
        if not provider.landed:
            raise ValueError(f"the texts of {provider.name} have not landed")
        served = chosen.where(F.col("text_source") == provider.name)
        texts = provider.table.select(F.col("rank.place").alias("text_place"), "text")
        texts = prune(texts, served, "text_place", total)
        hot = _hot(served, "text_place", total, rows_per_task)
        parts.append(lookup(served, texts, "text_place", how="inner", hot=hot, null_keys=False))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@dataclass(frozen=True)
class FullTexts:
    """``records`` with ``text``, ``text_source`` and ``metadata``; ``chosen`` is what was settled
    about them without text."""

    records: DataFrame
    chosen: DataFrame


def fetch(
    records: DataFrame,
    text_providers: Sequence[TextProvider],
    metadata_providers: Sequence[MetadataProvider],
    scratch: Scratch | None = None,
    *,
    rows_per_task: int = TEXT_ROWS_PER_TASK,
) -> FullTexts:
    """Settle sources and metadata on identifiers, keep both as tables, then fetch the texts."""
    scratch = scratch or Scratch(records.sparkSession, "fulltext")
    total = records.count()
    landed = [land(p, records, scratch, total=total) for p in text_providers]
    chosen = scratch.keep(
        choose_text_source(records, landed, rows_per_task=rows_per_task), "chosen"
    )
    described = scratch.keep(
        attach_metadata(chosen, metadata_providers, rows_per_task=rows_per_task, total=total),
        "described",
    )
    whole = attach_text(described, landed, rows_per_task=rows_per_task, total=total)
    others = [c for c in records.columns if c not in KINDS]
    return FullTexts(whole.select(*others, *KINDS, "text", "text_source", "metadata"), chosen)


def fulltext_records(
    records: DataFrame,
    text_providers: Sequence[TextProvider],
    metadata_providers: Sequence[MetadataProvider],
    scratch: Scratch | None = None,
    *,
    rows_per_task: int = TEXT_ROWS_PER_TASK,
) -> DataFrame:
    """Records with ``text``, ``text_source`` and ``metadata`` (null where there is no text)."""
    return fetch(
        records, text_providers, metadata_providers, scratch, rows_per_task=rows_per_task
    ).records
