import pytest
from pyspark.sql import functions as F

from citeloom.operators import fulltext as ft
from citeloom.operators import lookup as lk
from citeloom.sources import responses as resp
from tests.test_responses import SUMMARY, landed

RECORD = "pmid string, pmcid string, doi string"


def _texts(spark, **texts):
    return spark.createDataFrame(list(texts.items()) or [], "key string, text string")


def _metadata(df):
    return [
        ft.MetadataProvider("semantic-scholar", resp.graph_metadata(df), ("pmid", "doi")),
        ft.MetadataProvider("entrez", resp.summary_metadata(df), ("pmid",)),
    ]


def _providers(spark, a, b):
    return [ft.pubget(_texts(spark, **a)), ft.ace(_texts(spark, **b))]


def test_first_provider_is_preferred_and_metadata_falls_back(spark):
    records = spark.createDataFrame([("70010020", "PMC8800113", "10.5555/lit.2021.77")], RECORD)
    df = landed(
        spark,
        ("semantic-scholar", "70010020", 404, {"error": "x"}),
        ("semantic-scholar", "10.5555/lit.2021.77", 429, {"code": "429"}),
        ("entrez", "70010020", 200, SUMMARY),
    )
    providers = _providers(spark, {"PMC8800113": "pubget text"}, {"70010020": "ace text"})
    row = ft.fulltext_records(records, providers, _metadata(df)).first()
    assert (row["text"], row["text_source"]) == ("pubget text", "pubget")
    assert row["metadata"]["title"] == "A title" and row["metadata"]["source"] == "entrez"
    assert ft.text_errors(ft.choose_text_source(records, providers)).count() == 0


def test_second_provider_serves_a_miss_which_is_still_reported(spark):
    records = spark.createDataFrame(
        [("70010031", None, "10.5555/y"), ("5", "PMC5", None), ("6", "PMC6", None)], RECORD
    )
    df = landed(
        spark,
        ("semantic-scholar", "70010031", 429, {"code": "429"}),
        ("semantic-scholar", "10.5555/y", 200, {"title": "By DOI", "year": 2019}),
        ("entrez", "70010031", 200, {"result": {"70010031": {"title": "Not used"}}}),
    )
    providers = _providers(spark, {"PMC6": ""}, {"70010031": "ace text", "5": "five"})
    rows = {r["pmid"]: r for r in ft.fulltext_records(records, providers, _metadata(df)).collect()}
    assert rows["70010031"]["text_source"] == "ace"
    assert rows["70010031"]["metadata"]["title"] == "By DOI"
    assert rows["70010031"]["metadata"]["source"] == "semantic-scholar"
    assert (rows["5"]["text"], rows["6"]["text"]) == ("five", None)
    messages = [r["message"] for r in ft.text_errors(ft.choose_text_source(records, providers)).collect()]
    assert sorted(messages) == [
        "ACE returned no text for PMID 6",
        "PubGet returned no text for PMC5",
        "PubGet returned no text for PMC6",
    ]


def test_failure_has_no_text_and_no_metadata(spark):
    records = spark.createDataFrame([("999999999", None, None), (None, None, "10.1/only")], RECORD)
    df = landed(spark, ("entrez", "999999999", 200, {"result": {"999999999": {"title": "T"}}}))
    providers = _providers(spark, {}, {})
    rows = ft.fulltext_records(records, providers, _metadata(df)).collect()
    assert all(r["text"] is None and r["metadata"] is None for r in rows) and len(rows) == 2
    chosen = ft.choose_text_source(records, providers)
    # A record with a DOI alone is passed over without a message.
    assert [r["message"] for r in ft.text_errors(chosen).collect()] == ["ACE returned no text for PMID 999999999"]
    assert ft.without_text(chosen).count() == 2


@pytest.mark.parametrize("few_keys", [True, False])
def test_hot_keys_null_keys_and_copies(spark, monkeypatch, few_keys):
    if not few_keys:
        monkeypatch.setattr(lk, "BROADCAST_KEYS", 0)
    n = 3_000
    records = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("pmid"),
        F.when(F.col("id") % 3 == 0, F.lit("PMC1")).alias("pmcid"),
        F.concat(F.lit("10.1/"), "id").alias("doi"),
    )
    copies = spark.range(500).select(F.lit("PMC1").alias("key"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"))
    ace = spark.range(0, n, 2).select(F.col("id").cast("string").alias("key"), F.lit("b").alias("text"))
    rows = ft.fulltext_records(records, [ft.pubget(copies), ft.ace(ace)], [], rows_per_task=100)
    counts = {(r["text_source"], r["text"]): r["count"] for r in rows.groupBy("text_source", "text").count().collect()}
    served = len([i for i in range(n) if i % 3 and i % 2 == 0])
    assert counts == {("pubget", "t0"): 1_000, ("ace", "b"): served, (None, None): 2_000 - served}


def test_a_response_landed_twice_does_not_repeat_records(spark):
    records = spark.createDataFrame([("1", None, None), (None, None, "10.1/x")], RECORD)
    answer = {"title": "T", "year": 2019}
    df = landed(spark, *[("semantic-scholar", "1", 200, answer)] * 3)
    rows = ft.fulltext_records(records, _providers(spark, {}, {"1": "one"}), _metadata(df)).collect()
    assert sorted((r["pmid"] or "", r["metadata"] and r["metadata"]["title"]) for r in rows) == [("", None), ("1", "T")]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sources_are_settled_without_text_and_places_are_its_rows(spark, scratch):
    records = spark.createDataFrame([("1", "PMC1", None), ("2", None, None), (None, "PMC1", None)], RECORD)
    providers = _providers(spark, {"PMC1": "one"}, {"2": "two", "1": "unused"})
    landed = [ft.land(p, records, scratch) for p in providers]
    assert all(p.landed for p in landed) and ft.land(landed[0], records, scratch) is landed[0]
    chosen = ft.choose_text_source(records, landed)
    assert "text:string" not in _plan(chosen) and "lead:string,digest:string" in _plan(chosen)
    places = {(r["pmid"], r["pmcid"]): r["text_place"] for r in chosen.collect()}
    assert places["1", "PMC1"] == places[None, "PMC1"] != places["2", None]
    texts = [r["text"] for r in ft.attach_text(chosen, landed).collect()]
    assert sorted(texts) == ["one", "one", "two"]
    with pytest.raises(ValueError, match="pubget have not landed"):
        ft.attach_text(chosen, providers)


def test_texts_that_begin_alike_are_told_apart(spark):
    begin = "same " * 40
    copies = spark.createDataFrame([("1", begin + x) for x in "dbca"], "key string, text string")
    records = spark.createDataFrame([("1", None, None)], RECORD)
    taken = {ft.fulltext_records(records, [ft.ace(copies.repartition(n))], []).first()["text"] for n in (1, 3)}
    assert len(taken) == 1 and taken.pop().startswith(begin)
