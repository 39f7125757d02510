"""Every registered query runs; those with SQL match DuckDB row by row."""

import os

import pytest
from oracle import connect, difference, spark_result, sql_result

import __spark_entry__ as entry_point

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()
EMPTY_AT_SMALL_SCALE = {"C9_set_difference"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    got = spark_result(QUERIES[name](spark, SF))
    if name in SQL:
        assert difference(got, sql_result(con, SQL[name])) is None
    if name not in EMPTY_AT_SMALL_SCALE:
        assert got[1]


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 5
