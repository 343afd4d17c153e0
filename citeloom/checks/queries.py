"""Registered queries: each takes ``(spark, sf_dir)`` and runs over its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.checks.views import view
from citeloom.functions.dates import date_error, iso_date
from citeloom.functions.identifiers import (
    KINDS,
    classify,
    doi,
    find_pmcid,
    id_key,
    normalize_as,
    pmcid,
    pmid,
    strip,
)
from citeloom.functions.metadata import author_names, year_from_text
from citeloom.functions.once import evaluated
from citeloom.functions.text import html_to_text, record_slug
from citeloom.operators import fulltext as ft
from citeloom.operators import resolve as rs
from citeloom.operators.hashing import (
    file_digests,
    hash_identifiers,
    range_digests,
    tree_digests,
)
from citeloom.operators.merge import (
    conflict_messages,
    conflicts,
    grouped_members,
    in_output_order,
    merge,
    merge_paths,
    merged_records,
)
from citeloom.operators.ordering import dense_index, one_page, paged
from citeloom.operators.records import (
    dedup_identifiers,
    discarded_records,
    explode_identifiers,
    identifier_errors,
)
from citeloom.operators.search import contains, laid_out, lay_out, search
from citeloom.plans import manifest as m
from citeloom.scratch import Scratch
from citeloom.sources import responses as resp
from citeloom.sources.lines import (
    FULLTEXT_MISSING,
    dedup_triples,
    identifier_list,
    parse_records,
    read_records,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(name: str):
    def register(build):
        QUERIES[name] = build
        return build

    return register


# -- identifiers --------------------------------------------------------------------------


@_query("q_strip")
def _(spark, sf):
    return view(spark, sf, "raw_ids").select("k", strip(F.col("raw")).alias("stripped"))


@_query("q_normalize_ids")
def _(spark, sf):
    rows = evaluated(view(spark, sf, "raw_ids"), "k", classify(F.col("raw")).alias("i"))
    return rows.where(F.col("i.error").isNull()).select(
        "k", "i.kind", "i.value", id_key(F.col("i.kind"), F.col("i.value")).alias("id_key")
    )


@_query("q_normalize_errors")
def _(spark, sf):
    rows = evaluated(view(spark, sf, "raw_ids"), "k", classify(F.col("raw")).alias("i"))
    return rows.where(F.col("i.error").isNotNull()).select("k", "i.error")


@_query("q_kind_directed")
def _(spark, sf):
    raw = F.col("raw")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (F.col("k") % 3 + 1).cast("int"))
    return view(spark, sf, "raw_ids").select(
        "k",
        pmid(raw).alias("as_pmid"),
        pmcid(raw).alias("as_pmcid"),
        doi(raw).alias("as_doi"),
        normalize_as(kind, raw).alias("by_kind"),
    )


@_query("q_pmcid_extract")
def _(spark, sf):
    return view(spark, sf, "service_ids").select("k", find_pmcid(F.col("raw")).alias("pmcid"))


# -- records and merge --------------------------------------------------------------------


@_query("q_explode_ids")
def _(spark, sf):
    return explode_identifiers(view(spark, sf, "mixed_recs")).select("k", "kind", "value")


@_query("q_identifier_errors")
def _(spark, sf):
    return identifier_errors(view(spark, sf, "mixed_recs")).select("k", "message")


@_query("q_discarded")
def _(spark, sf):
    return discarded_records(view(spark, sf, "mixed_recs")).select("k", "path")


@_query("q_components")
def _(spark, sf):
    members = grouped_members(view(spark, sf, "recs"), Scratch(spark, "components"))
    return members.select("id", "component")


@_query("q_components_hub")
def _(spark, sf):
    # Low enough that the hub is spread over several tasks at any size.
    members = grouped_members(
        view(spark, sf, "hub_recs"), Scratch(spark, "hub"), rows_per_task=1_000
    )
    return members.select("id", "component")


@_query("q_components_chain")
def _(spark, sf):
    members = grouped_members(view(spark, sf, "chain_recs"), Scratch(spark, "chain"))
    return members.select("id", "component")


@_query("q_merge")
def _(spark, sf):
    return in_output_order(merge(view(spark, sf, "recs")).records)


@_query("q_merge_hub")
def _(spark, sf):
    return merged_records(grouped_members(view(spark, sf, "hub_recs"), Scratch(spark, "hub")))


@_query("q_conflicts")
def _(spark, sf):
    members = grouped_members(view(spark, sf, "recs"), Scratch(spark, "conflicts"))
    return conflict_messages(members)


@_query("q_conflicts_hub")
def _(spark, sf):
    members = grouped_members(view(spark, sf, "hub_recs"), Scratch(spark, "conflicts"))
    return conflict_messages(members, rows_per_task=1_000)


@_query("q_conflict_counts")
def _(spark, sf):
    members = grouped_members(view(spark, sf, "hub_recs"), Scratch(spark, "conflicts"))
    return conflicts(members)


# -- JSON Lines ---------------------------------------------------------------------------


@_query("q_jsonl_records")
def _(spark, sf):
    parsed = parse_records(view(spark, sf, "raw_lines"))
    return parsed.where(F.col("error").isNull()).select("path", "line_no", *KINDS)


@_query("q_jsonl_errors")
def _(spark, sf):
    parsed = parse_records(view(spark, sf, "raw_lines"))
    return parsed.where(F.col("error").isNotNull()).select(
        F.concat_ws("", "path", F.lit(":"), "line_no", F.lit(": "), "error").alias("message")
    )


@_query("q_dedup_triples")
def _(spark, sf):
    return dedup_triples(view(spark, sf, "recs"), ["path", "k"])


@_query("q_dedup_ids")
def _(spark, sf):
    rows = view(spark, sf, "recs").select("k", F.explode(F.array(*KINDS)).alias("raw"))
    ids = evaluated(rows, F.col("k").alias("pos"), classify(F.col("raw")).alias("i"))
    return dedup_identifiers(ids.where(F.col("i.error").isNull()).select("pos", "i.kind", "i.value"))


@_query("q_hash_ids")
def _(spark, sf):
    return hash_identifiers(view(spark, sf, "raw_ids"), "raw", mode="tree")


@_query("q_hash_files")
def _(spark, sf):
    return file_digests(view(spark, sf, "raw_lines"))


@_query("q_hash_bytes")
def _(spark, sf):
    path = _written_lines(spark, sf, "file_lines", Scratch(spark, "bytes"))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return tree_digests(range_digests(files, 512)).select(_file_number(), "digest")


# -- files written and read again ---------------------------------------------------------


@_query("q_merge_paths")
def _(spark, sf):
    scratch = Scratch(spark, "paths")
    m.write_records(view(spark, sf, "recs"), f"{scratch.path}/recs.jsonl")
    return merge_paths(spark, [f"{scratch.path}/recs.jsonl"], scratch).records


@_query("q_identifier_list")
def _(spark, sf):
    path = f"{Scratch(spark, 'ids').path}/ids.txt"
    m.write_id_list(view(spark, sf, "inputs"), path, "raw")
    return identifier_list(spark, path).select("raw")


@_query("q_id_list")
def _(spark, sf):
    path = f"{Scratch(spark, 'ids').path}/pmids.txt"
    m.write_id_list(view(spark, sf, "corpus"), path, "doc_id")
    return spark.read.text(path).select(F.col("value").alias("pmid"))


@_query("q_landed")
def _(spark, sf):
    path = f"{Scratch(spark, 'landed').path}/responses"
    view(spark, sf, "responses").write.mode("overwrite").parquet(path)
    return resp.read_responses(spark, path)


# -- search -------------------------------------------------------------------------------


def _found(spark, sf):
    return search(view(spark, sf, "corpus"), contains("URGENT"), "1996-01-01", "1997-12-31")


@_query("q_search")
def _(spark, sf):
    return _found(spark, sf).select("doc_id", F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"))


@_query("q_search_open_end")
def _(spark, sf):
    return search(view(spark, sf, "corpus"), contains("HIGH"), start="1999-06-01").select("doc_id")


@_query("q_search_documents")
def _(spark, sf):
    path = f"{Scratch(spark, 'corpus').path}/by-month"
    lay_out(view(spark, sf, "dated_documents"), path)
    found = search(laid_out(spark, path), contains(" an"), "1992-03-15", "1997-10-01")
    return found.select("doc_id", F.date_format("pub_date", "yyyy-MM-dd").alias("pub_date"))


@_query("q_search_pages")
def _(spark, sf):
    found = search(view(spark, sf, "corpus"), contains("LOW")).select("doc_id", "pub_date")
    return paged(dense_index(found, ["pub_date", "doc_id"]), 100).select("doc_id", "position", "page")


@_query("q_page_slice")
def _(spark, sf):
    ids = view(spark, sf, "corpus").select("doc_id", "pub_date")
    return one_page(dense_index(ids, ["pub_date", "doc_id"]), 1_000, 500).select("doc_id", "position")


@_query("q_dates")
def _(spark, sf):
    return view(spark, sf, "date_texts").select(
        "k",
        F.date_format(iso_date(F.col("raw")), "yyyy-MM-dd").alias("day"),
        date_error("start-date", F.col("raw")).alias("error"),
    )


# -- landed responses ---------------------------------------------------------------------


@_query("q_esearch_pages")
def _(spark, sf):
    return resp.esearch_ids(view(spark, sf, "search_pages"))


@_query("q_esearch_errors")
def _(spark, sf):
    return resp.esearch_errors(view(spark, sf, "search_pages"))


@_query("q_status_routing")
def _(spark, sf):
    return resp.response_errors(view(spark, sf, "responses"))


@_query("q_idconv")
def _(spark, sf):
    return resp.idconv_crosswalk(view(spark, sf, "responses"))


@_query("q_esummary_ids")
def _(spark, sf):
    return resp.esummary_crosswalk(view(spark, sf, "responses"))


@_query("q_semi_requested")
def _(spark, sf):
    wanted = view(spark, sf, "article_recs").select("pmid").where("pmid IS NOT NULL")
    return resp.esummary_crosswalk(view(spark, sf, "responses"), wanted)


@_query("q_external_ids")
def _(spark, sf):
    return resp.external_ids(view(spark, sf, "responses"))


def _flat(meta: DataFrame) -> DataFrame:
    return meta.select(
        "key",
        "metadata.title",
        "metadata.abstract",
        F.array_join("metadata.authors", "|").alias("authors"),
        "metadata.journal",
        "metadata.year",
        "metadata.source",
    )


@_query("q_meta_graph")
def _(spark, sf):
    return _flat(resp.graph_metadata(view(spark, sf, "responses")))


@_query("q_meta_summary")
def _(spark, sf):
    return _flat(resp.summary_metadata(view(spark, sf, "responses")))


@_query("q_authors")
def _(spark, sf):
    rows = view(spark, sf, "responses").where("source = 'semantic-scholar'")
    raw = F.get_json_object("body", "$.authors")
    return rows.select("request_key", F.array_join(author_names(raw), "|").alias("authors"))


@_query("q_years")
def _(spark, sf):
    rows = view(spark, sf, "responses").where("source = 'entrez'")
    return rows.select("request_key", year_from_text(F.col("body")).alias("year"))


# -- resolve ------------------------------------------------------------------------------


def _crosswalks(spark, sf) -> list[rs.Crosswalk]:
    return [
        rs.idconv(view(spark, sf, "xw_idconv")),
        rs.esummary(view(spark, sf, "xw_esummary")),
        rs.graph(view(spark, sf, "xw_graph")),
    ]


def _stages(spark, sf, upto: int = 3) -> rs.Stages:
    inputs, _ = rs.classified_inputs(view(spark, sf, "inputs"))
    return rs.lookup_stages(inputs, _crosswalks(spark, sf)[:upto])


def _stage(number: int):
    def build(spark, sf):
        links = list(_stages(spark, sf, number).links.values())[-1]
        return links.where(F.col("value").isNotNull()).select("id", "kind", "value")

    return build


QUERIES["q_resolve_stage1"] = _stage(1)
QUERIES["q_resolve_stage2"] = _stage(2)
QUERIES["q_resolve_stage3"] = _stage(3)


@_query("q_resolve")
def _(spark, sf):
    inputs, _ = rs.classified_inputs(view(spark, sf, "inputs"))
    found = rs.resolve(inputs, _crosswalks(spark, sf))
    return rs.in_input_order(found.records).select(*KINDS, "pos")


def _disputed(spark, sf) -> rs.Resolution:
    inputs, _ = rs.classified_inputs(view(spark, sf, "disputed_inputs"))
    scratch = Scratch(spark, "disputed")
    stages = [rs.esummary(view(spark, sf, "disputed_summaries")), rs.graph(view(spark, sf, "disputed_graph"))]
    ready = [
        rs.prepare(x, f"prepared_{i}_{uuid.uuid4().hex}", f"{scratch.path}/prepared-{i}", 8)
        for i, x in enumerate(stages)
    ]
    return rs.resolve(inputs, ready, scratch)


@_query("q_resolve_latest")
def _(spark, sf):
    return _disputed(spark, sf).records.select(*KINDS, "pos")


@_query("q_resolve_conflicts")
def _(spark, sf):
    return _disputed(spark, sf).conflicts


@_query("q_sources_used")
def _(spark, sf):
    return rs.sources_frame(spark, _stages(spark, sf).used)


@_query("q_resolve_errors")
def _(spark, sf):
    return _stages(spark, sf).errors


# -- full text ----------------------------------------------------------------------------


def _providers(spark, sf):
    pages = html_to_text(view(spark, sf, "text_a"))
    documents = view(spark, sf, "text_b").select("key", strip(F.col("text")).alias("text"))
    return [ft.pubget(pages), ft.ace(documents)]


def _chosen(spark, sf):
    return ft.choose_text_source(view(spark, sf, "article_recs"), _providers(spark, sf))


@_query("q_html_text")
def _(spark, sf):
    return html_to_text(view(spark, sf, "text_a"))


@_query("q_text_fallback")
def _(spark, sf):
    scratch, records = Scratch(spark, "text"), view(spark, sf, "article_recs")
    landed = [ft.land(p, records, scratch) for p in _providers(spark, sf)]
    chosen = scratch.keep(ft.choose_text_source(records, landed), "chosen")
    return ft.attach_text(chosen, landed).select("doc_id", "text_source", "text")


@_query("q_text_errors")
def _(spark, sf):
    return ft.text_errors(_chosen(spark, sf)).select("doc_id", "message")


@_query("q_no_text")
def _(spark, sf):
    return ft.without_text(_chosen(spark, sf)).select("doc_id")


def _metadata_providers(spark, sf):
    responses = view(spark, sf, "article_responses")
    return [
        ft.MetadataProvider(resp.GRAPH, resp.graph_metadata(responses), ("pmid", "doi")),
        ft.MetadataProvider(resp.ESUMMARY, resp.summary_metadata(responses), ("pmid",)),
    ]


def _described(records: DataFrame, *columns: str) -> DataFrame:
    return records.select(
        *columns,
        "metadata.title",
        F.array_join("metadata.authors", "|").alias("authors"),
        "metadata.journal",
        "metadata.year",
        "metadata.source",
    )


@_query("q_metadata_fallback")
def _(spark, sf):
    chosen = Scratch(spark, "metadata").keep(_chosen(spark, sf), "chosen")
    return _described(ft.attach_metadata(chosen, _metadata_providers(spark, sf)), "doc_id")


def _written_lines(spark, sf, name: str, scratch: Scratch) -> str:
    """A view's lines as text files of bounded length, one folder ``file=<n>`` each."""
    path = f"{scratch.path}/{name}"
    lines = view(spark, sf, name).repartition("file").sortWithinPartitions("file", "line_no")
    lines.select("file", "value").write.mode("overwrite").partitionBy("file").text(path)
    return path


def _file_number(path: str = "path") -> Column:
    return F.regexp_extract(path, "/file=([0-9]+)/", 1).cast("bigint").alias("file")


@_query("q_line_errors")
def _(spark, sf):
    scratch = Scratch(spark, "lines")
    path = _written_lines(spark, sf, "file_lines", scratch)
    _, errors = read_records(spark, path, scratch=scratch)
    message = F.regexp_extract("message", ":([0-9]+: .*)$", 1).alias("message")
    return errors.select(_file_number(), "line_no", message)


@_query("q_fulltext_records")
def _(spark, sf):
    scratch = Scratch(spark, "fulltext")
    path = _written_lines(spark, sf, "article_lines", scratch)
    loaded, _ = read_records(spark, path, FULLTEXT_MISSING, scratch)
    # Folders are named by numbers, which do not order as the paths' texts do.
    placed = dedup_triples(loaded.withColumn("file", _file_number()), ["file", "block", "line_id"])
    indexed = dense_index(placed, ["file", "block", "line_id"], "index", scratch)
    records = scratch.keep(indexed.select("index", *KINDS), "records")
    whole = ft.fulltext_records(
        records, _providers(spark, sf), _metadata_providers(spark, sf), scratch
    )
    slug = record_slug(F.col("pmid"), F.col("pmcid"), F.col("doi"), F.col("index"))
    return _described(whole, slug.alias("slug"), *KINDS, "text", "text_source")


@_query("q_fulltext_errors")
def _(spark, sf):
    scratch = Scratch(spark, "fulltext")
    path = _written_lines(spark, sf, "article_lines", scratch)
    _, errors = read_records(spark, path, FULLTEXT_MISSING, scratch)
    message = F.regexp_extract("message", ":([0-9]+: .*)$", 1).alias("message")
    return errors.select(_file_number(), "line_no", message)


@_query("q_slug")
def _(spark, sf):
    recs = view(spark, sf, "article_recs")
    return recs.select(
        "doc_id",
        record_slug(F.col("pmid"), F.col("pmcid"), F.col("doi"), F.col("doc_id")).alias("slug"),
    )


# -- reports ------------------------------------------------------------------------------


@_query("q_run_counts")
def _(spark, sf):
    return m.text_counts(_chosen(spark, sf))


@_query("q_input_counts")
def _(spark, sf):
    ids = view(spark, sf, "recs").select(F.explode(F.array(*KINDS)).alias("raw"))
    good = evaluated(ids, classify(F.col("raw")).alias("i")).where(F.col("i.error").isNull())
    return m.input_counts(good.select("i.kind", "i.value"))


@_query("q_error_log")
def _(spark, sf):
    lines = parse_records(view(spark, sf, "raw_lines"))
    read = lines.where(F.col("error").isNotNull()).select(
        F.lit("read").alias("stage"), "path", "line_no", F.col("error").alias("message")
    )
    good = lines.where(F.col("error").isNull())
    bad = identifier_errors(good.select("path", *KINDS)).select(
        F.lit("normalize").alias("stage"), "path", "message"
    )
    services = resp.response_errors(view(spark, sf, "responses")).select(
        F.col("source").alias("stage"), "message"
    )
    return m.error_log(read, bad, services)
