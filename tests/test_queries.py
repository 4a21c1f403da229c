import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck

D = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def con():
    return duck(D)


@pytest.mark.parametrize("name", sorted(n for n in SQL if n in QUERIES))
def test_against_sql(spark, con, name):
    state, _, why = compare(spark, con, QUERIES[name], SQL[name], D)
    assert state == "ok", why


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    QUERIES[name](spark, D).collect()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
