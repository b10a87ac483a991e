"""Every registered query: equal to its SQL twin, or at least one row where SQL cannot express it."""

import pytest
from compare import connect, differences

from brightledger.plans.catalog import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql_twin(name, spark, folder, con):
    diff, _ = differences(QUERIES[name](spark, folder), con, SQL[name])
    assert diff is None, diff


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(name, spark, folder):
    assert not QUERIES[name](spark, folder).isEmpty()
