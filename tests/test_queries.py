"""Every registered query on the smallest tables: equal to its SQL, or at least rows."""

import pytest

import __spark_entry__ as entry
from tests.compare import check, connect

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_sql_has_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, rows, _, note = check(spark, con, name, QUERIES[name], SQL.get(name), SF)
    assert ok is not False, note
    assert ok or rows > 0


def test_entry(spark):
    assert len(entry.entry(spark).columns) > 50
