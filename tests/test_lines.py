import pytest

from pyspark.sql import functions as F

from citeloom.functions.jsontext import is_single_value
from citeloom.sources.lines import (
    FULLTEXT_MISSING,
    dedup_triples,
    identifier_list,
    read_lines,
    read_records,
    with_line_numbers,
)


def test_errors_name_file_and_physical_line(spark, write_lines):
    b = write_lines("b.jsonl", ["", '{"pmid":"1"}', "{bad", "   ", "[1,2]", '"text"', '{"title":"x"}'])
    a = write_lines("a.jsonl", ['{"pmid":"1"} trailing', '{"pmid":0}', '{"pmid":"0"}', "{'pmid':'1'}"])
    records, errors = read_records(spark, [b, a])
    assert sorted(r["message"] for r in errors.collect()) == sorted(
        [
            f"{a}:1: invalid JSON",
            f"{a}:2: row has no recognizable identifiers",
            f"{a}:4: invalid JSON",
            f"{b}:3: invalid JSON",
            f"{b}:5: expected JSON object per line",
            f"{b}:6: expected JSON object per line",
            f"{b}:7: row has no recognizable identifiers",
        ]
    )
    assert sorted(r["pmid"] for r in records.collect()) == ["0", "1"]


@pytest.mark.parametrize("value, present", [
    ('""', False), ("0", False), ("0.0", False), ("-0", False), ("false", False), ("[]", False),
    ("{}", False), ("null", False), ('"0"', True), ('"false"', True), ('"[]"', True), ('" "', True),
    ("1", True), ("true", True), ("[0]", True), ('{"a":1}', True), ("1e3", True),
])
def test_truth_of_json_values(spark, write_lines, value, present):
    path = write_lines("t.jsonl", [f'{{"doi":{value}}}'])
    records, _ = read_records(spark, [path])
    assert records.count() == int(present)


def test_line_numbers_across_many_splits(spark, tmp_path):
    lines = ["" if i % 7 == 0 else f"row {i}" for i in range(1, 5_001)]
    path = tmp_path / "big.txt"
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        read = read_lines(spark, str(path))
        assert read.select("block").distinct().count() > 5
        numbered = with_line_numbers(read.where("value <> ''"), read)
        got = {r["value"]: r["line_no"] for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {text: i for i, text in enumerate(lines, 1) if text}


def test_text_is_read_once(spark, write_lines):
    path = write_lines("o.jsonl", ['{"pmid":"1"}', "", "{bad"])
    records, errors = read_records(spark, [path])
    for part in (records, errors):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "FileScan text" not in plan and "FileScan parquet" in plan
    assert [r["line_no"] for r in errors.collect()] == [3]


def test_identifier_list_strips_and_drops_blank_lines(spark, tmp_path):
    path = tmp_path / "ids.txt"
    path.write_text(" 1 \r\n\n \nPMC2\x0b10.1/x\n", encoding="utf-8", newline="")
    found = identifier_list(spark, str(path)).orderBy("pos").collect()
    assert [r["raw"] for r in found] == ["1", "PMC2", "10.1/x"]
    empty = tmp_path / "empty.txt"
    empty.write_text("\n \n")
    with pytest.raises(ValueError, match="contains no identifiers"):
        identifier_list(spark, str(empty))


def test_triples_are_deduplicated_across_files_first_kept(spark, write_lines):
    a = write_lines("a.jsonl", [{"pmid": "1", "doi": None}, {"pmid": " 1"}, {"pmid": "1"}])
    b = write_lines("b.jsonl", [{"pmid": "1", "pmcid": None}, {"doi": "10.1/A"}, {"x": 1}])
    records, errors = read_records(spark, [b, a], FULLTEXT_MISSING)
    kept = dedup_triples(records).orderBy("path", "block", "line_id").collect()
    assert [(r["path"], r["pmid"], r["doi"]) for r in kept] == [
        (a, "1", None), (a, " 1", None), (b, None, "10.1/A"),
    ]
    assert [r["message"] for r in errors.collect()] == [f"{b}:3: record missing identifiers"]


@pytest.mark.parametrize(
    "text",
    ['{"pmid":"1"}] junk', '{"pmid":"2"}],[{', '{"pmid":"3"} ] }', '{"pmid":"4"},5', '{"pmid":"5"} x', "{", "", "]", "1] 2"],
)
def test_what_follows_a_json_value_makes_it_invalid(spark, text):
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(is_single_value(F.col("t"))).first()[0] is False


@pytest.mark.parametrize("text", ['{"pmid":"1"}', " [1, 2] ", "3", '"]"', "null", '{"a":[{}]}'])
def test_whole_json_values(spark, text):
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(is_single_value(F.col("t"))).first()[0] is True
