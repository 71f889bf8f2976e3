"""Every registered query against its SQL twin, over whole tables."""

import pytest

from pressmill.plans.catalog import ORACLES, QUERIES
from tests.oracle import connect, difference, spark_rows, sql_rows


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_names_match():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, folder, con):
    mine = spark_rows(QUERIES[name](spark, folder))
    assert not difference(mine, sql_rows(con, ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql(name, spark, folder):
    assert QUERIES[name](spark, folder).count() > 0
