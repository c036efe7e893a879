"""Every core query with SQL gives on the smallest data what DuckDB gives."""

import pytest

from railyard.plans import registry
from tests.oracle import compare, connect

SQL = registry.oracle_sql()
QUERIES = registry.queries()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, small, con, name):
    compare(spark, con, small, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0


def test_entry(spark, small):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
