"""The four runs a user starts. Each writes under a path named by its input's content hash, so
running it again replaces the same folder, all at once when the new run is complete."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.dates import parse_date_option, utc_stamp
from citeloom.functions.identifiers import id_key
from citeloom.functions.text import record_slug
from citeloom.operators.fulltext import (
    MetadataProvider,
    TextProvider,
    fetch,
    text_errors,
)
from citeloom.operators.hashing import hash_files, hash_identifiers, hash_values
from citeloom.operators.merge import in_output_order, merge_paths
from citeloom.operators.ordering import dense_index
from citeloom.operators.resolve import (
    Crosswalk,
    classified_inputs,
    in_input_order,
    resolve,
)
from citeloom.operators.search import search
from citeloom.plans import manifest as m
from citeloom.plans.layout import DataLayout
from citeloom.plans.publish import publishing
from citeloom.scratch import Scratch
from citeloom.sources.lines import FULLTEXT_MISSING, dedup_triples, identifier_list, read_records

Clock = Callable[[], dt.datetime]


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


@dataclass(frozen=True)
class Run:
    """What a run wrote: its folder, its manifest row, and its records read back."""

    path: str
    manifest: DataFrame
    records: DataFrame


def search_run(
    corpus: DataFrame,
    query: str,
    predicate: Column,
    *,
    start: str | None = None,
    end: str | None = None,
    page_size: int = 1000,
    id_column: str = "pmid",
    order: Sequence[str] | None = None,
    layout: DataLayout | None = None,
    clock: Clock = _utc_now,
) -> Run:
    """Search a corpus and keep the ids found, in order, under the query's hash and the day."""
    if page_size < 1:
        raise ValueError("page size must be at least 1")
    spark = corpus.sparkSession
    layout = layout or DataLayout.from_session(spark)
    first, last = parse_date_option("start-date", start), parse_date_option("end-date", end)
    parts = [query] + [f"start:{start}"] * bool(start) + [f"end:{end}"] * bool(end)
    started = clock()
    path = layout.search_run(hash_values(parts), started.strftime("%Y%m%d"))

    found = search(corpus, predicate, first, last).orderBy(*(order or [id_column]))
    with publishing(spark, path) as attempt:
        row = m.one_row(
            spark,
            m.SEARCH_SCHEMA,
            {
                "source": "pubmed",
                "query": query,
                "start_date": first and first.isoformat(),
                "end_date": last and last.isoformat(),
                "result_count": m.write_id_list(found, f"{attempt}/pmids.txt", id_column),
                "run_started_at": utc_stamp(started),
                "retmax": page_size,
            },
        )
        m.write_manifest(row, attempt)
    ids = spark.read.text(f"{path}/pmids.txt").withColumnRenamed("value", "pmid")
    return Run(path, row, ids)


def resolve_run(
    spark: SparkSession,
    input_file: str,
    crosswalks: Sequence[Crosswalk],
    *,
    service_errors: DataFrame | None = None,
    strict: bool = True,
    layout: DataLayout | None = None,
    clock: Clock = _utc_now,
) -> Run:
    """Resolve a file of identifiers; ``service_errors`` are error rows of landed responses."""
    layout = layout or DataLayout.from_session(spark)
    with Scratch(spark, "resolve") as scratch:
        started = clock()
        good, bad = classified_inputs(identifier_list(spark, input_file, scratch), strict)
        inputs = scratch.keep(good, "inputs")
        keys = inputs.select(id_key(F.col("kind"), F.col("value")).alias("id"))
        digest = hash_identifiers(keys).first()["hash"]
        path = layout.resolve_run(digest)

        result = resolve(inputs, crosswalks, scratch)
        parts = [bad, result.errors]
        if service_errors is not None:
            parts.append(service_errors.select(F.col("source").alias("stage"), "message"))
        counts = m.input_counts(inputs).first()
        with publishing(spark, path) as attempt:
            ordered = in_input_order(result.records)
            row = m.one_row(
                spark,
                m.RESOLVE_SCHEMA,
                {
                    "input_file": input_file,
                    "input_count": counts["input_count"],
                    "unique_inputs": counts["unique_inputs"],
                    "record_count": m.write_records(ordered, f"{attempt}/records.jsonl"),
                    "sources": m.sources_used(result.sources).first()["sources"],
                    "error_count": m.write_errors(m.error_log(*parts), attempt),
                    "errors_path": m.errors_path(path),
                    "input_hash": digest,
                    "run_started_at": utc_stamp(started),
                    "records_path": f"{path}/records.jsonl",
                },
            )
            m.write_manifest(row, attempt)
        return Run(path, row, _read_records(spark, f"{path}/records.jsonl"))


def merge_run(
    spark: SparkSession,
    input_files: Sequence[str],
    *,
    layout: DataLayout | None = None,
    clock: Clock = _utc_now,
) -> Run:
    """Merge record files into deduplicated records."""
    if not input_files:
        raise ValueError("Provide at least one JSONL file")
    layout = layout or DataLayout.from_session(spark)
    started = clock()
    digest = hash_files(spark, input_files)
    path = layout.merge_run(digest)

    with Scratch(spark, "merge") as scratch:
        result = merge_paths(spark, input_files, scratch)
        with publishing(spark, path) as attempt:
            ordered = in_output_order(result.records)
            row = m.one_row(
                spark,
                m.MERGE_SCHEMA,
                {
                    "input_files": sorted(input_files),
                    "input_hash": digest,
                    "record_count": m.write_records(ordered, f"{attempt}/records.jsonl"),
                    "error_count": m.write_errors(m.error_log(result.errors), attempt),
                    "errors_path": m.errors_path(path),
                    "run_started_at": utc_stamp(started),
                    "records_path": f"{path}/records.jsonl",
                },
            )
            m.write_manifest(row, attempt)
        return Run(path, row, _read_records(spark, f"{path}/records.jsonl"))


def fulltext_run(
    spark: SparkSession,
    input_files: Sequence[str],
    text_providers: Sequence[TextProvider],
    metadata_providers: Sequence[MetadataProvider],
    *,
    record_format: str = "parquet",
    layout: DataLayout | None = None,
    clock: Clock = _utc_now,
) -> Run:
    """Fetch text and metadata for record files; failures are written too, without text.

    Records are written as ``parquet`` or ``json``, one row or document each, named by ``slug``.
    """
    if not input_files:
        raise ValueError("At least one JSONL file must be provided")
    layout = layout or DataLayout.from_session(spark)
    with Scratch(spark, "fulltext") as scratch:
        started = clock()
        digest = hash_files(spark, input_files)
        path = layout.fulltext_run(digest)

        loaded, parse_errors = read_records(spark, input_files, FULLTEXT_MISSING, scratch)
        indexed = dense_index(
            dedup_triples(loaded), ["path", "block", "line_id"], "index", scratch
        ).select("index", "pmid", "pmcid", "doi")
        records = scratch.keep(indexed, "records")
        found = fetch(records, text_providers, metadata_providers, scratch)
        chosen, whole = found.chosen, found.records

        read = parse_errors.select(F.lit("read").alias("stage"), "path", "line_no", "message")
        missed = text_errors(chosen).select(F.lit("text").alias("stage"), "message")
        slug = record_slug(F.col("pmid"), F.col("pmcid"), F.col("doi"), F.col("index"))
        named = whole.select(
            slug.alias("slug"), "pmid", "pmcid", "doi", "text", "text_source", "metadata"
        )

        def served(column: str, name: str) -> Column:
            return F.count_if(F.col(column) == name)

        texts = [p.name for p in text_providers]
        answers = [p.name for p in metadata_providers]
        counted = m.Counted(
            named,
            with_text=F.count("text_source"),
            **{f"text-{i}": served("text_source", name) for i, name in enumerate(texts)},
            **{f"metadata-{i}": served("metadata.source", name) for i, name in enumerate(answers)},
        )
        with publishing(spark, path) as attempt:
            write = counted.df.write.format(record_format).options(**m.JSON_NULLS)
            write.mode("overwrite").save(f"{attempt}/records")
            n = counted.get()
            row = m.one_row(
                spark,
                m.FULLTEXT_SCHEMA,
                {
                    "input_files": list(input_files),
                    "input_hash": digest,
                    "record_count": n["rows"],
                    "records_with_text": n["with_text"],
                    "records_without_text": n["rows"] - n["with_text"],
                    "text_sources": sorted(x for i, x in enumerate(texts) if n[f"text-{i}"]),
                    "metadata_sources": sorted(
                        x for i, x in enumerate(answers) if n[f"metadata-{i}"]
                    ),
                    "error_count": m.write_errors(m.error_log(read, missed), attempt),
                    "errors_path": m.errors_path(path),
                    "run_started_at": utc_stamp(started),
                    "records_dir": f"{path}/records",
                },
            )
            m.write_manifest(row, attempt)
        written = spark.read.schema(m.FULLTEXT_RECORD).format(record_format)
        return Run(path, row, written.load(f"{path}/records"))


def _read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("pmid STRING, pmcid STRING, doi STRING").json(path)
