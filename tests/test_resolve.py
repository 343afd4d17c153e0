import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citeloom.operators import resolve as rs
from citeloom.sources import responses as resp
from tests.test_responses import GRAPH_IDS, IDCONV, SUMMARY, landed


def _inputs(spark, *raw):
    rows = spark.createDataFrame(list(enumerate(raw)), "pos int, raw string")
    return rs.classified_inputs(rows)[0]


def _stages(df):
    return [
        rs.idconv(resp.idconv_crosswalk(df)),
        rs.esummary(resp.esummary_crosswalk(df)),
        rs.graph(resp.external_ids(df)),
    ]


def _rows(df):
    return [(r["pmid"], r["pmcid"], r["doi"]) for r in df.collect()]


def test_three_ids_become_one_record_with_all_sources(spark):
    df = landed(
        spark,
        ("pmc", "PMC8800113", 200, IDCONV),
        ("entrez", "70010020", 200, SUMMARY),
        ("semantic-scholar", "10.5555/lit.2021.77", 200, GRAPH_IDS),
        ("semantic-scholar", "70010020", 404, {"error": "not found"}),
    )
    result = rs.resolve(_inputs(spark, "70010020", "PMC8800113", "10.5555/lit.2021.77"), _stages(df))
    assert _rows(result.records) == [("70010020", "PMC8800113", "10.5555/lit.2021.77")]
    assert {r["source"] for r in result.sources.collect()} == {"pmc", "entrez", "semantic-scholar"}
    assert result.errors.count() == 0 and result.conflicts.count() == 0


def test_all_services_failing_leaves_the_inputs(spark):
    df = landed(
        spark,
        ("pmc", "PMC8800113", 500, "x"),
        ("entrez", "70010020", 500, "x"),
        ("semantic-scholar", "70010020", 500, "x"),
    )
    result = rs.resolve(_inputs(spark, "70010020", "PMC8800113"), _stages(df))
    assert _rows(rs.in_input_order(result.records)) == [("70010020", None, None), (None, "PMC8800113", None)]
    assert result.sources.count() == 0
    messages = " ".join(r["message"] for r in resp.response_errors(df).collect())
    assert all(name in messages for name in ("pmc", "entrez", "semantic-scholar"))


def _xw(spark, rows):
    return spark.createDataFrame(rows, "kind string, value string, pmid string, pmcid string, doi string")


def test_stage_one_looks_up_inputs_only_and_stage_two_uses_its_finds(spark):
    first = rs.Crosswalk("pmc", _xw(spark, [("pmcid", "PMC1", "1", None, None), ("pmcid", "PMC2", "2", None, None)]), ("pmcid",), True)
    second = rs.Crosswalk("entrez", _xw(spark, [("pmid", "1", None, "PMC2", "10.1/A")]), ("pmid",))
    third = rs.graph(_xw(spark, [("doi", "10.1/a", None, None, None), ("pmcid", "PMC2", "9", None, None)]))
    result = rs.resolve(_inputs(spark, "PMC1"), [first, second, third])
    # PMC2 was found, not given: neither the first nor the third stage looks it up.
    assert {r["value"] for r in result.members.collect()} == {"PMC1", "1", "PMC2", "10.1/a"}
    assert {r["source"] for r in result.sources.collect()} == {"pmc", "entrez", "semantic-scholar"}


def test_latest_stage_wins_and_the_loser_is_reported(spark):
    first = rs.Crosswalk("a", _xw(spark, [("pmid", "1", None, "PMC9", "10.1/x")]), ("pmid",))
    second = rs.Crosswalk("b", _xw(spark, [("doi", "10.1/x", "1", "PMC5", None)]), ("doi",))
    result = rs.resolve(_inputs(spark, "1"), [first, second])
    assert _rows(result.records) == [("1", "PMC5", "10.1/x")]
    assert [(r["kind"], r["value"], r["kept"]) for r in result.conflicts.collect()] == [("pmcid", "PMC9", "PMC5")]


def test_bad_service_values_are_error_rows(spark):
    xw = rs.Crosswalk("a", _xw(spark, [("pmid", "1", None, "bad", "10.1/x")]), ("pmid",))
    result = rs.resolve(_inputs(spark, "1"), [xw])
    assert _rows(result.records) == [("1", None, "10.1/x")]
    assert [tuple(r) for r in result.errors.collect()] == [("a", "Invalid PMCID: bad")]


def test_input_order_repeats_and_no_crosswalks(spark):
    result = rs.resolve(_inputs(spark, "7", "PMC3", "7", "2"), [])
    assert _rows(rs.in_input_order(result.records)) == [("7", None, None), (None, "PMC3", None), ("2", None, None)]


def test_strict_and_lenient_inputs(spark):
    rows = spark.createDataFrame([(0, "1"), (1, "bad id")], "pos int, raw string")
    good, errors = rs.classified_inputs(rows, strict=False)
    assert good.count() == 1
    assert [r["message"] for r in errors.collect()] == ["Unrecognized identifier: bad id"]
    with pytest.raises(PySparkException, match="Unrecognized identifier"):
        rs.classified_inputs(rows)[0].collect()


def test_many_keys_take_the_shuffled_path_with_a_hot_crosswalk_key(spark, monkeypatch):
    monkeypatch.setattr(rs, "BROADCAST_KEYS", 10)
    n = 3_000
    table = spark.range(n).select(
        F.lit("pmid").alias("kind"),
        F.when(F.col("id") % 3 == 0, F.lit("0")).otherwise(F.col("id").cast("string")).alias("value"),
        F.lit(None).cast("string").alias("pmid"),
        F.concat(F.lit("PMC"), "id").alias("pmcid"),
        F.lit(None).cast("string").alias("doi"),
    )
    ids = spark.range(n).select(F.col("id").alias("pos"), F.lit("pmid").alias("kind"), F.col("id").cast("string").alias("value"))
    result = rs.resolve(ids, [rs.Crosswalk("x", table, ("pmid",))], rows_per_task=100)
    assert result.records.count() == n
    assert result.conflicts.count() == n // 3 - 1


def test_a_prepared_crosswalk_is_read_as_it_lies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(rs, "BROADCAST_KEYS", 10)
    rows = [("pmid", f" {i % 400}", None, f"PMC{i}", None) for i in range(900)] + [("pmid", "x", "1", None, None)] * 2
    plain = rs.Crosswalk("x", _xw(spark, rows), ("pmid",))
    ready = rs.prepare(plain, "prepared_crosswalk", str(tmp_path / "xw"), 5)
    keys = spark.range(300).select(F.lit("pmid").alias("kind"), F.col("id").cast("string").alias("value"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = rs.stage_hits(keys, ready)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        got, want = (sorted(h.select("id", "pmcid").collect()) for h in (hits, rs.stage_hits(keys, plain)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE prepared_crosswalk")
    assert got == want and len(got) == 700
    table = plan[: plan.index("prepared_crosswalk")]
    assert "Bucketed: true" in plan and "Exchange" not in table[table.index("SortMergeJoin") :]


def test_keys_are_numbered_without_their_parts_and_conflicts_give_them_back(spark, scratch):
    from citeloom.operators.resolve import Crosswalk, resolve

    inputs = spark.createDataFrame([(1, "doi", "10.1/a:b c")], "pos long, kind string, value string")
    table = spark.createDataFrame(
        [("doi", "10.1/a:b c", "7", None, None), ("doi", "10.1/a:b c", "8", None, "10.1/x y:z")],
        "kind string, value string, pmid string, pmcid string, doi string",
    )
    columns, keep = {}, scratch.keep
    scratch.keep = lambda df, name, **options: columns.setdefault(name, df.columns) and keep(df, name, **options)
    found = resolve(inputs, [Crosswalk("graph", table)], scratch)
    assert columns["ordered-number"] == ["id", "stage", "pos"]
    rows = {(r["component"], r["kind"], r["value"], r["kept"]) for r in found.conflicts.collect()}
    assert rows == {
        ("doi:10.1/a:b c", "pmid", "7", "8"),
        ("doi:10.1/a:b c", "doi", "10.1/a:b c", "10.1/x y:z"),
    }
