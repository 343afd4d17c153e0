"""Every registered query against its SQL in DuckDB, on the smallest given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from citeloom.checks.oracles import ORACLES
from citeloom.checks.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["pmid", "pmcid", "doi"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    result = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert sorted(names) == columns
    assert rows == want and rows
