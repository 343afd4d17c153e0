import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from citeloom.functions import identifiers as ids

CASES = [
    ("123456", "pmid", "123456"),
    ("pmc1234", "pmcid", "PMC1234"),
    ("pmcid:PMC999", "pmcid", "PMC999"),
    ("10.1000/ABC", "doi", "10.1000/abc"),
    ("PMID: 12", "pmid", "12"),
    ("00012", "pmid", "00012"),
    ("PMCID:7", "pmcid", "PMC7"),
    ("doi:10.1/X", "doi", "10.1/x"),
    ("doi: 10.1/X", "doi", " 10.1/x"),
    ("https://doi.org/10.1/X", "doi", "https://doi.org/10.1/x"),
    ("   42　\n", "pmid", "42"),
    ("pmid: 7", "pmid", "7"),
]
ERRORS = [
    ("", "Identifier cannot be blank"),
    (" \t ", "Identifier cannot be blank"),
    (None, "Identifier cannot be blank"),
    ("not an id", "Unrecognized identifier: not an id"),
    (" not an id", "Unrecognized identifier:  not an id"),
    ("PMCID: PMC7", "Invalid PMCID: PMCID: PMC7"),
    ("doi:101", "Unrecognized identifier: doi:101"),
    ("pmid:10.1/x", "Invalid PMID: 10.1/x"),
    ("pmid: ", "Empty PMID provided"),
    ("pmc/1", "Invalid PMCID: pmc/1"),
    ("pmcPMC1", "Invalid PMCID: pmcPMC1"),
    ("12²", "Unrecognized identifier: 12²"),
]


def _classified(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "raw string")
    return [r["i"] for r in rows.select(ids.classify(F.col("raw")).alias("i")).collect()]


def test_classify_accepts_every_form(spark):
    found = _classified(spark, [c[0] for c in CASES])
    assert [(i["original"], i["kind"], i["value"]) for i in found] == CASES
    assert all(i["error"] is None for i in found)


def test_classify_reports_bad_values_as_data(spark):
    found = _classified(spark, [c[0] for c in ERRORS])
    assert [(i["original"], i["error"]) for i in found] == ERRORS
    assert all(i["kind"] is None and i["value"] is None for i in found)


def test_strict_mode_fails_on_bad_values(spark):
    rows = spark.createDataFrame([("1",), ("nope",)], "raw string")
    with pytest.raises(PySparkException, match="Unrecognized identifier: nope"):
        rows.select(ids.require_key(F.col("raw"))).collect()


def test_strip_matches_python_for_every_code_point(spark):
    points = [chr(c) for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(p + "x" + p,) for p in points], "v string")
    got = [r[0] for r in rows.select(ids.strip(F.col("v"))).collect()]
    assert got == [(p + "x" + p).strip() for p in points]


def test_kind_directed_and_lenient_forms(spark):
    row = spark.sql("SELECT ' pmcid:5 ' a, 'pmc-id: PMC123; PMC9' b, 'PMCX' c, 'none' d, '  ' e").select(
        ids.normalize_as("pmcid", F.col("a")),
        ids.find_pmcid(F.col("b")),
        ids.find_pmcid(F.col("c")),
        ids.find_pmcid(F.col("d")),
        ids.find_pmcid(F.col("e")),
        ids.doi(F.lit("DOI:10.1/Z")),
        ids.pmid(F.lit("1a")),
    ).first()
    assert list(row) == ["PMC5", "PMC123", "PMCX", None, None, "10.1/z", None]
