import random

from pyspark.sql import functions as F

from citeloom.operators.merge import (
    conflict_messages,
    grouped_members,
    in_output_order,
    merge,
    merge_paths,
    merged_records,
)
from citeloom.scratch import Scratch


def _rows(df):
    return [(r["pmid"], r["pmcid"], r["doi"]) for r in df.collect()]


def test_overlapping_records_become_one(spark, write_lines):
    a = write_lines("a.jsonl", [{"pmid": "808"}, {"pmid": "31", "doi": None}])
    b = write_lines("b.jsonl", [{"pmid": "808", "pmcid": "pmc4040"}])
    c = write_lines("c.jsonl", [{"pmcid": "PMC4040", "doi": "10.55/Chain"}, {"doi": "10.55/CHAIN"}])
    result = merge_paths(spark, [c, b, a])
    assert sorted(_rows(result.records)) == [("31", None, None), ("808", "PMC4040", "10.55/chain")]
    assert result.errors.count() == 0


def test_conflict_keeps_the_smallest_and_is_reported(spark, write_lines):
    path = write_lines("c.jsonl", [{"pmid": "52", "doi": f"10.9/{x}"} for x in "QPR"])
    result = merge_paths(spark, [path])
    assert _rows(result.records) == [("52", None, "10.9/p")]
    assert sorted(r["message"] for r in result.errors.collect()) == [
        "Conflicting doi values encountered: ['10.9/p', '10.9/q']",
        "Conflicting doi values encountered: ['10.9/p', '10.9/r']",
    ]


def test_smallest_is_by_text_not_by_number(spark):
    records = spark.createDataFrame(
        [("9", None, "10.1/x"), ("10", None, "10.1/x")], "pmid string, pmcid string, doi string"
    )
    assert _rows(merge(records).records) == [("10", None, "10.1/x")]


def test_disconnected_and_idless_rows(spark, write_lines):
    path = write_lines("d.jsonl", [{"pmid": "64"}, {"journal": "Nothing"}, {"pmcid": "PMC65"}])
    result = merge_paths(spark, [path])
    assert set(_rows(result.records)) == {("64", None, None), (None, "PMC65", None)}
    errors = result.errors.collect()
    assert [(e["line_no"], e["message"]) for e in errors] == [
        (2, f"{path}:2: row has no recognizable identifiers")
    ]


def test_bad_values_give_errors_and_good_siblings_survive(spark, write_lines):
    path = write_lines("e.jsonl", [{"pmid": "x y", "doi": "10.1/q"}, {"pmid": "x y"}, {"pmcid": "12"}, {"doi": "  "}])
    result = merge_paths(spark, [path])
    assert set(_rows(result.records)) == {(None, None, "10.1/q"), ("12", None, None)}
    gone = f"{path}: record discarded after normalization due to missing identifiers"
    assert sorted(r["message"] for r in result.errors.collect()) == sorted(
        [f"{path}: Unrecognized identifier: x y"] * 2 + [gone] * 2
    )


def test_output_order_puts_doi_then_pmcid_then_pmid(spark):
    records = spark.createDataFrame(
        [("5", None, None), (None, "PMC1", None), (None, None, "10.1/z"), ("10", "PMC2", None)],
        "pmid string, pmcid string, doi string",
    )
    assert _rows(in_output_order(merge(records).records)) == [
        (None, None, "10.1/z"), (None, "PMC1", None), ("10", "PMC2", None), ("5", None, None),
    ]


def test_merge_is_idempotent_and_order_free(spark):
    rng = random.Random(3)
    rows = [
        (str(rng.randrange(60)), rng.choice([None, f"PMC{rng.randrange(60)}"]), rng.choice([None, f"10.1/{rng.randrange(60)}"]))
        for _ in range(120)
    ]
    schema = "pmid string, pmcid string, doi string"
    once = merge(spark.createDataFrame(rows, schema)).records
    shuffled = merge(spark.createDataFrame(rows[::-1], schema).repartition(7)).records
    assert sorted(_rows(once), key=repr) == sorted(_rows(shuffled), key=repr)
    assert sorted(_rows(merge(once).records), key=repr) == sorted(_rows(once), key=repr)


def test_one_conflict_row_per_value_at_every_size(spark):
    records = spark.range(500).select(
        F.col("id").cast("string").alias("pmid"),
        F.lit(None).cast("string").alias("pmcid"),
        F.lit("10.1/hub").alias("doi"),
    )
    members = grouped_members(records, Scratch(spark, "t"), rows_per_task=50)
    assert _rows(merged_records(members)) == [("0", None, "10.1/hub")]
    rows = conflict_messages(members, rows_per_task=50).collect()
    assert sorted(r["message"] for r in rows) == sorted(
        f"Conflicting pmid values encountered: ['0', '{i}']" for i in range(1, 500)
    )
    assert sorted(rows) == sorted(conflict_messages(members).collect())


def test_conflict_lists_quote_values(spark):
    records = spark.createDataFrame(
        [("1", None, "10.1/a'b"), ("1", None, '10.1/"\''), ("1", None, "10.1/c\\d")],
        "pmid string, pmcid string, doi string",
    )
    messages = sorted(r["message"] for r in merge(records).errors.collect())
    least, *others = sorted(["10.1/a'b", '10.1/"\'', "10.1/c\\d"])
    assert messages == sorted(f"Conflicting doi values encountered: {[least, v]}" for v in others)
