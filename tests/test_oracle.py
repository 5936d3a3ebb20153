"""Every query with an oracle must match DuckDB (small fixture for speed)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle import compare, duck

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, entry.queries()[name], SQL[name], SF_SMALL)
    assert res["cols_match"], res
    assert res["rows_spark"] == res["rows_duck"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "rsi" in df.columns


def test_every_query_has_ops_and_runs_lazily(spark):
    from barflow.plans.catalog import QUERIES

    assert len(QUERIES) >= 60
    assert all(q.ops for q in QUERIES.values())
