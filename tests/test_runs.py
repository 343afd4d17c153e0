import datetime as dt
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from citeloom.functions.dates import date_error, iso_date, parse_date_option
from citeloom.operators import fulltext as ft
from citeloom.operators import resolve as rs
from citeloom.operators.hashing import hash_files, hash_identifiers
from citeloom.operators.ordering import dense_index, one_page, paged, with_previous
from citeloom.operators.search import contains, laid_out, lay_out, search
from citeloom.plans import manifest as m
from citeloom.plans.layout import DataLayout
from citeloom.plans.runs import fulltext_run, merge_run, resolve_run, search_run
from citeloom.sources import responses as resp
from tests.test_responses import GRAPH_IDS, IDCONV, SUMMARY, landed


def clock():
    return dt.datetime(2024, 1, 15, 12, 0, 0, tzinfo=dt.timezone.utc)


def _lines(spark, path):
    return [json.loads(r["value"]) for r in spark.read.text(path).collect()]


@pytest.fixture
def corpus(spark):
    rows = [(str(i), f"brain {i}" if i % 2 else "heart", dt.date(2024, 1, 1 + i)) for i in range(20)]
    return spark.createDataFrame(rows, "pmid string, text string, pub_date date").repartition(3)


def test_search_bounds_are_inclusive_and_open(spark, corpus):
    found = search(corpus, contains("brain"), "2024-01-04", "2024-01-08")
    assert sorted(r["pmid"] for r in found.collect()) == ["3", "5", "7"]
    assert search(corpus, contains("brain"), start="2024-01-18").count() == 2
    assert search(corpus, contains("brain")).count() == 10
    with pytest.raises(ValueError, match="Invalid date for end-date: 2024-1-8"):
        search(corpus, contains("brain"), end="2024-1-8")


def test_search_filters_reach_the_scan(spark, corpus, tmp_path):
    corpus.write.parquet(str(tmp_path / "c"))
    found = search(spark.read.parquet(str(tmp_path / "c")), contains("brain"), "2024-01-04").select("pmid")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pub_date" in plan and "StringContains(text,brain)" in plan


def test_dates(spark):
    rows = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("2024-1-5",), ("20240105",), (None,)], "d string")
    got = rows.select(iso_date(F.col("d")).alias("day"), date_error("start-date", F.col("d")).alias("e")).collect()
    assert got[0]["day"] == dt.date(2024, 2, 29) and got[0]["e"] is None
    assert [r["e"] for r in got[1:4]] == [f"Invalid date for start-date: {d}" for d in ("2023-02-29", "2024-1-5", "20240105")]
    assert got[4]["day"] is None and got[4]["e"] is None
    assert parse_date_option("x", None) is None


def test_dense_index_and_pages(spark):
    df = spark.range(1_000).select((F.col("id") * 7919 % 1_000).alias("v")).repartition(6)
    indexed = dense_index(df, ["v"])
    assert all(r["v"] == r["position"] for r in indexed.collect())
    assert [r["v"] for r in one_page(indexed, 990, 100).orderBy("v").collect()] == list(range(990, 1_000))
    assert paged(indexed, 300).groupBy("page").count().orderBy("page").collect()[-1]["count"] == 100
    with pytest.raises(ValueError, match="at least 1"):
        paged(indexed, 0)
    assert dense_index(df.where("v < 0"), ["v"]).count() == 0


@pytest.mark.parametrize("run", [1, 7, 100, 10_000])
def test_previous_rows_across_runs(spark, run):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("v"))
    before = with_previous(dense_index(df, ["v"]), ["v"], run=run)
    got = {r["v"]: r["previous_v"] for r in before.collect()}
    assert got == {v: v - 1 if v else None for v in range(500)}


def test_layout(spark, monkeypatch):
    monkeypatch.delenv("CITELOOM_DATA_ROOT", raising=False)
    assert DataLayout.from_session(spark).raw == "data/raw"
    monkeypatch.setenv("CITELOOM_DATA_ROOT", "/x/")
    layout = DataLayout.from_session(spark)
    assert (layout.raw, layout.interim, layout.processed, layout.final) == ("/x/raw", "/x/interim", "/x/processed", "/x/final")
    assert layout.merge_run("h") == "/x/processed/merged/h"


def test_search_run(spark, corpus, tmp_path):
    layout = DataLayout(str(tmp_path))
    run = search_run(corpus, "brain", contains("brain"), start="2024-01-02", end="2024-01-06", layout=layout, clock=clock)
    digest = hashlib.sha256("\n".join(sorted(["brain", "start:2024-01-02", "end:2024-01-06"])).encode()).hexdigest()[:16]
    assert run.path == f"{tmp_path}/raw/pubmed/{digest}/20240115"
    assert [r["value"] for r in spark.read.text(f"{run.path}/pmids.txt").collect()] == ["1", "3", "5"]
    assert m.read_manifest(spark, run.path) == {
        "source": "pubmed", "query": "brain", "start_date": "2024-01-02", "end_date": "2024-01-06",
        "result_count": 3, "run_started_at": "2024-01-15T12:00:00Z", "retmax": 1000,
    }
    again = search_run(corpus, "brain", contains("brain"), layout=layout, clock=clock)
    assert again.path != run.path and m.read_manifest(spark, again.path)["start_date"] is None


def test_resolve_run(spark, tmp_path):
    ids = tmp_path / "ids.txt"
    ids.write_text("70010020\nPMC8800113\n\n10.5555/lit.2021.77\n70010020\n")
    df = landed(spark, ("pmc", "PMC8800113", 200, IDCONV), ("entrez", "70010020", 200, SUMMARY), ("semantic-scholar", "70010020", 429, GRAPH_IDS))
    stages = [rs.idconv(resp.idconv_crosswalk(df)), rs.esummary(resp.esummary_crosswalk(df)), rs.graph(resp.external_ids(df))]
    run = resolve_run(spark, str(ids), stages, service_errors=resp.response_errors(df), layout=DataLayout(str(tmp_path)), clock=clock)
    keys = ["pmid:70010020", "pmcid:PMC8800113", "doi:10.5555/lit.2021.77", "pmid:70010020"]
    digest = hash_identifiers(spark.createDataFrame([(k,) for k in keys], "id string")).first()["hash"]
    assert run.path == f"{tmp_path}/interim/resolved/{digest}"
    assert _lines(spark, f"{run.path}/records.jsonl") == [
        {"pmid": "70010020", "pmcid": "PMC8800113", "doi": "10.5555/lit.2021.77"}
    ]
    row = m.read_manifest(spark, run.path)
    assert (row["input_count"], row["unique_inputs"], row["record_count"]) == (4, 3, 1)
    assert row["sources"] == ["entrez", "pmc"] and row["input_hash"] == digest
    assert row["error_count"] == 1
    assert _messages(spark, row) == ["semantic-scholar: error 429 for 70010020"]


def _messages(spark, row):
    return [r["message"] for r in spark.read.parquet(row["errors_path"]).collect()]


def test_merge_run_writes_nulls_and_repeats_in_place(spark, tmp_path, write_lines):
    a = write_lines("a.jsonl", [{"pmid": "1"}, {"doi": "10.1/only"}, "{bad"])
    b = write_lines("b.jsonl", [{"pmid": "1", "pmcid": "PMC1", "doi": "10.1/ABC"}])
    layout = DataLayout(str(tmp_path))
    run = merge_run(spark, [b, a], layout=layout, clock=clock)
    assert merge_run(spark, [a, b], layout=layout, clock=clock).path == run.path
    assert _lines(spark, f"{run.path}/records.jsonl") == [
        {"pmid": None, "pmcid": None, "doi": "10.1/only"},
        {"pmid": "1", "pmcid": "PMC1", "doi": "10.1/abc"},
    ]
    assert m.read_manifest(spark, run.path) == {
        "input_files": [a, b], "input_hash": hash_files(spark, [a, b]), "record_count": 2,
        "error_count": 1, "errors_path": f"{run.path}/errors", "run_started_at": "2024-01-15T12:00:00Z",
        "records_path": f"{run.path}/records.jsonl",
    }
    assert _messages(spark, m.read_manifest(spark, run.path)) == [f"{a}:3: invalid JSON"]
    with pytest.raises(ValueError):
        merge_run(spark, [])


@pytest.mark.parametrize("record_format", ["parquet", "json"])
def test_fulltext_run(spark, tmp_path, write_lines, record_format):
    path = write_lines("r.jsonl", [{"pmid": "1", "pmcid": "PMC1"}, {"doi": "10.1/a"}, {"pmid": "2"}, {"pmid": "2"}, {"x": 1}])
    df = landed(spark, ("entrez", "2", 200, {"result": {"2": {"title": "Two", "pubdate": "2001"}}}))
    run = fulltext_run(
        spark, [path],
        [ft.pubget(spark.createDataFrame([("PMC1", "one")], "key string, text string")),
         ft.ace(spark.createDataFrame([("2", "two")], "key string, text string"))],
        [ft.MetadataProvider("entrez", resp.summary_metadata(df), ("pmid",))],
        record_format=record_format, layout=DataLayout(str(tmp_path)), clock=clock,
    )
    if record_format == "json":
        failed = [d for d in _lines(spark, f"{run.path}/records") if d["slug"] == "0001_10_1_a"]
        assert failed[0]["text"] is None and failed[0]["metadata"] is None
    rows = {r["slug"]: r for r in run.records.collect()}
    assert set(rows) == {"0000_1", "0001_10_1_a", "0002_2"}
    assert rows["0000_1"]["text"] == "one" and rows["0000_1"]["metadata"] is None
    assert rows["0001_10_1_a"]["text"] is None
    assert rows["0002_2"]["metadata"]["title"] == "Two" and rows["0002_2"]["metadata"]["year"] == 2001
    row = m.read_manifest(spark, run.path)
    assert (row["record_count"], row["records_with_text"], row["records_without_text"]) == (3, 2, 1)
    assert row["text_sources"] == ["ace", "pubget"] and row["metadata_sources"] == ["entrez"]
    assert _messages(spark, row) == [f"{path}:5: record missing identifiers"] and row["input_files"] == [path]
    assert os.path.isdir(row["records_dir"])


def test_every_error_is_in_the_error_table(spark, tmp_path):
    errors = spark.range(2_000).select(
        F.lit("s").alias("stage"), F.lit(None).cast("string").alias("path"),
        F.col("id").alias("line_no"), F.concat(F.lit("e"), "id").alias("message"),
    )
    assert m.write_errors(errors, str(tmp_path)) == 2_000
    assert m.write_errors(errors.where("line_no < 0"), str(tmp_path / "none")) == 0
    assert spark.read.parquet(m.errors_path(str(tmp_path))).select("message").distinct().count() == 2_000


@pytest.mark.parametrize("broken", ["write_errors", "write_manifest"])
def test_a_run_that_fails_leaves_the_earlier_one_whole(spark, tmp_path, write_lines, monkeypatch, broken):
    a = write_lines("a.jsonl", [{"pmid": "1"}, "{bad"])
    layout = DataLayout(str(tmp_path / "data"))
    run = merge_run(spark, [a], layout=layout, clock=clock)
    before = {p: p.read_bytes() for p in sorted((tmp_path / "data").rglob("*")) if p.is_file()}
    monkeypatch.setattr(m, broken, lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        merge_run(spark, [a], layout=layout, clock=clock)
    assert {p: p.read_bytes() for p in sorted((tmp_path / "data").rglob("*")) if p.is_file()} == before
    monkeypatch.undo()
    again = merge_run(spark, [a], layout=layout, clock=clock)
    assert m.read_manifest(spark, again.path)["record_count"] == 1
    assert os.listdir(os.path.dirname(run.path)) == [os.path.basename(run.path)]


def test_date_bounds_prune_months(spark, corpus, tmp_path):
    days = corpus.select("pmid", "text", (F.col("pub_date") + F.col("pmid").cast("int") * 20).alias("pub_date"))
    lay_out(days.unionByName(days.selectExpr("'x' AS pmid", "text", "cast(NULL AS date) AS pub_date")), str(tmp_path / "c"))
    laid = laid_out(spark, str(tmp_path / "c"))
    found = search(laid, contains("brain"), "2024-03-01", "2024-06-30").select("pmid")
    want = search(days, contains("brain"), "2024-03-01", "2024-06-30").select("pmid")
    assert sorted(found.collect()) == sorted(want.collect()) and found.count()
    plan = found._jdf.queryExecution().executedPlan().toString()
    pruned = plan[plan.index("PartitionFilters: [") :].split("]")[0]
    assert "2024-03" in pruned and "2024-06" in pruned
    assert search(laid, contains("heart")).count() == 20


def test_scratch_goes_when_a_run_fails(spark, tmp_path, monkeypatch):
    closed = []
    monkeypatch.setattr("citeloom.scratch.Scratch.close", lambda self: closed.append(self.path))
    monkeypatch.setattr("citeloom.plans.runs.resolve", lambda *a: 1 / 0)
    ids = tmp_path / "ids.txt"
    ids.write_text("7\n")
    with pytest.raises(ZeroDivisionError):
        resolve_run(spark, str(ids), [], layout=DataLayout(str(tmp_path)), clock=clock)
    assert len(closed) == 1
