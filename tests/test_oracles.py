"""Every query with an SQL oracle gives the same rows as DuckDB (sf0.001; the driver uses sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMOKE_DIR
from tests.oracle_compare import assert_same, duck

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SMOKE_DIR).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert_same(got, want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["dt", "avg_value", "avg_k", "avg_user_id", "avg_price"]


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = E.queries()[name](spark, SMOKE_DIR)
    assert df.count() > 0
