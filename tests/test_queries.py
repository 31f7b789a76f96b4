"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
import catalogue
from conftest import DATA
from oracle import connect, difference

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(name, spark, con):
    assert name in SQL
    assert difference(QUERIES[name](spark, DATA), con, SQL[name]) is None


def test_entry(spark):
    assert [tuple(r)[:2] for r in entry.entry(spark).collect()] == sorted(
        tuple(r)[:2] for r in entry.entry(spark).collect())
