"""Every registered query against its SQL, on the smallest data."""

import pytest

import __spark_entry__ as e
from ledgerline.catalog import ORACLE, QUERIES
from compare import compare, connect
from conftest import DATA

SQL = ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    rows, error = compare(spark, DATA, name, QUERIES[name], SQL.get(name), con)
    assert error is None, error
    assert rows >= 0


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) <= set(e.queries()) and set(SQL) <= set(e.oracle_sql())
    assert set(QUERIES) == set(SQL)
