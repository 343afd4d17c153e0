"""Staged resolution of identifiers against crosswalk tables.

Each stage looks up the identifiers known so far in one crosswalk and links what it finds. The
linked identifiers form a graph whose components are the resolved records; one closure at the
end serves all stages, since a stage needs the set of known values, not their grouping.

Where a component holds several values of one kind, the value first asserted by the latest stage
is the record's; among those of one stage the largest. The other values are in ``conflicts``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.identifiers import (
    KINDS,
    compact,
    id_key,
    identifier_error,
    identifier_key,
    key_kind,
    key_value,
    normalize_as,
    require_key,
)
from citeloom.operators.components import components
from citeloom.operators.lookup import BROADCAST_KEYS, ROWS_PER_TASK, hot_keys, lookup, prune
from citeloom.operators.records import dedup_identifiers
from citeloom.scratch import Scratch


@dataclass(frozen=True)
class Crosswalk:
    """A lookup service as a table: ``kind, value`` looked up; ``pmid, pmcid, doi`` asserted.

    ``kinds`` says which identifiers are looked up; ``inputs_only`` limits them to the inputs,
    leaving out those found by earlier stages. A prepared crosswalk's table has the normalized key
    ``id`` in place of ``kind, value`` and is bucketed and sorted by it (:func:`prepare`).
    """

    name: str
    table: DataFrame
    kinds: tuple[str, ...] = KINDS
    inputs_only: bool = False
    prepared: bool = False


def idconv(table: DataFrame, name: str = "pmc") -> Crosswalk:
    """Id-conversion stage from ``pmcid, pmid, doi``: input PMCIDs only."""
    keyed = table.select(
        F.lit("pmcid").alias("kind"),
        F.col("pmcid").alias("value"),
        "pmid",
        F.lit(None).cast("string").alias("pmcid"),
        "doi",
    )
    return Crosswalk(name, keyed, ("pmcid",), inputs_only=True)


def esummary(table: DataFrame, name: str = "entrez") -> Crosswalk:
    """Summary stage from ``pmid, pmcid, doi``: all PMIDs known so far."""
    keyed = table.select(
        F.lit("pmid").alias("kind"),
        F.col("pmid").alias("value"),
        F.lit(None).cast("string").alias("pmid"),
        "pmcid",
        "doi",
    )
    return Crosswalk(name, keyed, ("pmid",))


def graph(table: DataFrame, name: str = "semantic-scholar") -> Crosswalk:
    """Paper-graph stage from ``kind, value, pmid, pmcid, doi``: all known PMIDs and DOIs."""
    return Crosswalk(name, table, ("pmid", "doi"))


def _keyed(crosswalk: Crosswalk) -> DataFrame:
    """``id, pmid, pmcid, doi`` of the rows that can be looked up."""
    if crosswalk.prepared:
        return crosswalk.table
    # Exploded rather than selected: the null check the join adds would work the key out twice.
    key = id_key(F.col("kind"), normalize_as(F.col("kind"), F.col("value")))
    return crosswalk.table.where(F.col("kind").isin(*crosswalk.kinds)).select(
        F.explode(F.array(key)).alias("id"), *KINDS
    )


def prepare(crosswalk: Crosswalk, table_name: str, path: str, buckets: int) -> Crosswalk:
    """Write a crosswalk once, keys normalized, bucketed and sorted by them, exact copies dropped.

    Lookups of any number of keys then shuffle the keys alone: the crosswalk is read as it lies.
    ``table_name`` names it in the session's catalog, ``path`` is where its files are.
    """
    keyed = _keyed(crosswalk).where(F.col("id").isNotNull()).distinct()
    (
        keyed.repartition(buckets, "id")
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "id")
        .sortBy("id")
        .saveAsTable(table_name)
    )
    table = keyed.sparkSession.table(table_name)
    return replace(crosswalk, table=table, prepared=True)


@dataclass(frozen=True)
class Resolution:
    """``records`` (pmid, pmcid, doi, pos, component), ``members``, ``conflicts``, ``sources``
    (source), ``errors`` (stage, message) and ``stage_links`` per stage name."""

    records: DataFrame
    members: DataFrame
    conflicts: DataFrame
    sources: DataFrame
    errors: DataFrame
    scratch: Scratch
    stage_links: dict[str, DataFrame] = field(default_factory=dict)


def classified_inputs(raw: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split ``pos, raw`` rows into identifiers ``pos, kind, value`` and errors.

    Strict mode fails the job on the first bad identifier; lenient mode reports it as a row.
    """
    value = F.col("raw")
    key = require_key(value) if strict else identifier_key(value)
    # Exploding drops null keys and works each key out once; a filter would do it twice.
    good = raw.select("pos", F.explode(compact(key)).alias("id")).select(
        "pos", key_kind(F.col("id")).alias("kind"), key_value(F.col("id")).alias("value")
    )
    errors = raw.where(identifier_key(value).isNull()).select(
        F.lit("input").alias("stage"), identifier_error(value).alias("message")
    )
    return good, errors


def stage_hits(
    keys: DataFrame,
    crosswalk: Crosswalk,
    bound: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Crosswalk rows for the ``kind, value`` keys, exact copies dropped.

    ``bound`` is an upper limit on the number of keys. Keys are made unique and the crosswalk may
    not be, so it is the crosswalk side that is spread when one key has very many rows.
    """
    table = _keyed(crosswalk)
    wanted = (
        keys.where(F.col("kind").isin(*crosswalk.kinds))
        .select(id_key(F.col("kind"), F.col("value")).alias("id"))
        .distinct()
    )
    bound = keys.count() if bound is None else bound
    if bound <= BROADCAST_KEYS:
        hits = prune(table, wanted, "id", bound)
    else:
        total = crosswalk.table.count()
        hot = hot_keys(table, "id", total=total, rows_per_task=rows_per_task)
        hits = lookup(table, wanted, "id", how="inner", hot=hot, null_keys=False)
    return hits if crosswalk.prepared else hits.distinct()


def stage_links(hits: DataFrame) -> DataFrame:
    """``id, kind, value, raw``: one row per asserted identifier; a bad one has a null value.

    Every hit keeps a row for the first kind, with nulls if it asserts none, so that a hit
    without identifiers still counts as an answer.
    """
    asserted = F.array(
        *[
            F.struct(
                F.lit(k).alias("kind"),
                normalize_as(k, F.col(k)).alias("value"),
                F.nullif(F.col(k), F.lit("")).alias("raw"),
            )
            for k in KINDS
        ]
    )
    links = hits.select("id", F.explode(asserted).alias("a")).select("id", "a.*")
    return links.where(F.col("raw").isNotNull() | (F.col("kind") == KINDS[0]))


@dataclass(frozen=True)
class Stages:
    """What the lookups found: ``seeds``, the links of each stage by name, the sources that
    answered, and error rows for bad values."""

    seeds: DataFrame
    links: dict[str, DataFrame]
    used: list[str]
    errors: DataFrame


def lookup_stages(
    identifiers: DataFrame,
    crosswalks: Sequence[Crosswalk],
    scratch: Scratch | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> Stages:
    """Look ``pos, kind, value`` rows up in the crosswalks in order, without grouping them."""
    spark: SparkSession = identifiers.sparkSession
    scratch = scratch or Scratch(spark, "stages")
    seeds = scratch.keep(dedup_identifiers(identifiers), "seeds")
    known, bound = seeds.select("kind", "value"), seeds.count()
    errors = spark.createDataFrame([], "stage string, message string")
    used, links_by_stage = [], {}
    for rank, crosswalk in enumerate(crosswalks, start=1):
        keys = seeds if crosswalk.inputs_only else known
        hits = stage_hits(keys, crosswalk, bound, rows_per_task)
        links = scratch.keep(stage_links(hits), f"links-{rank}")
        bad = links.where(F.col("value").isNull() & F.col("raw").isNotNull())
        text = F.concat(F.lit("Invalid "), F.upper("kind"), F.lit(": "), F.col("raw"))
        errors = errors.unionByName(
            bad.select(F.lit(crosswalk.name).alias("stage"), text.alias("message"))
        )
        found = links.count()
        if found:
            used.append(crosswalk.name)
        bound += found
        known = known.unionByName(links.where("value IS NOT NULL").select("kind", "value"))
        links_by_stage[crosswalk.name] = links
    return Stages(seeds, links_by_stage, used, errors)


def resolve(
    identifiers: DataFrame,
    crosswalks: Sequence[Crosswalk],
    scratch: Scratch | None = None,
    *,
    rows_per_task: int = ROWS_PER_TASK,
) -> Resolution:
    """Resolve ``pos, kind, value`` rows (normalized) through the crosswalks in order."""
    spark: SparkSession = identifiers.sparkSession
    scratch = scratch or Scratch(spark, "resolve")
    before = scratch.tables()
    stages = lookup_stages(identifiers, crosswalks, scratch, rows_per_task=rows_per_task)

    no_position = F.lit(None).cast(stages.seeds.schema["pos"].dataType)
    key = id_key(F.col("kind"), F.col("value"))
    asserted = stages.seeds.select(key.alias("id"), F.lit(0).alias("stage"), "pos")
    all_edges = spark.createDataFrame([], "src string, dst string")
    for rank, links in enumerate(stages.links.values(), start=1):
        good = links.where(F.col("value").isNotNull())
        asserted = asserted.unionByName(
            good.select(key.alias("id"), F.lit(rank).alias("stage"), no_position.alias("pos"))
        )
        all_edges = all_edges.unionByName(good.select(F.col("id").alias("src"), key.alias("dst")))

    # Kinds and values are taken from the keys at the end, so that nothing carries them twice.
    vertices = asserted.groupBy("id").agg(F.min("stage").alias("stage"), F.min("pos").alias("pos"))
    found = components(vertices, all_edges, scratch, rows_per_task=rows_per_task)
    members = found.select(
        key_kind(F.col("id")).alias("kind"),
        key_value(F.col("id")).alias("value"),
        "stage",
        "pos",
        "id",
        "component",
    )
    members = scratch.keep(members, "members")

    kept = [f"links-{rank}" for rank in range(1, len(crosswalks) + 1)]
    scratch.drop_since(before, keep=("members", *kept))

    latest = F.struct("stage", "value")
    records = (
        members.groupBy("component")
        .agg(
            *[F.max(F.when(F.col("kind") == k, latest))["value"].alias(k) for k in KINDS],
            F.min("pos").alias("pos"),
        )
        .select(*KINDS, "pos", "component")
    )
    return Resolution(
        records,
        members,
        losing_values(members, rows_per_task),
        sources_frame(spark, stages.used),
        stages.errors,
        scratch,
        stages.links,
    )


def sources_frame(spark: SparkSession, used: Sequence[str]) -> DataFrame:
    """``source``: one row per stage that answered."""
    return spark.createDataFrame([(name,) for name in used], "source string")


def losing_values(members: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``component, kind, value, kept``: values that did not become the record's."""
    group = F.concat_ws(" ", "kind", "component")
    winners = (
        members.groupBy(group.alias("group"))
        .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("stage", "value")).alias("w"))
        .where(F.col("n") > 1)
        .select("group", F.col("w.value").alias("kept"))
    )
    # The group names both kind and component; a kind has no space.
    facts = members.select(group.alias("group"), "value")
    hot = hot_keys(facts, "group", total=members.count(), rows_per_task=rows_per_task)
    joined = lookup(facts, winners, "group", how="inner", hot=hot, null_keys=False)
    return joined.where(F.col("value") != F.col("kept")).select(
        F.expr("substring(group, locate(' ', group) + 1)").alias("component"),
        F.substring_index("group", " ", 1).alias("kind"),
        "value",
        "kept",
    )


def in_input_order(records: DataFrame) -> DataFrame:
    """Records in the order their first identifier was given."""
    return records.orderBy("pos")
