"""Every registered query with SQL returns what DuckDB returns."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference

SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_same_as_sql(spark, sf, db, name):
    assert difference(QUERIES[name](spark, sf), db, SQL[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert [r["grade"] for r in rows] == list("ABCDEFG")
