"""Every registered query of the package against its SQL twin, or for rows where it has none."""

import pytest
from compare import connect, differences

from brightledger.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql_twin(name, spark, folder, con):
    diff, _ = differences(QUERIES[name](spark, folder), con, SQL[name])
    assert diff is None, diff


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(name, spark, folder):
    assert not QUERIES[name](spark, folder).isEmpty()
