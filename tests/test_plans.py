"""Physical-plan properties: pushdown, pruning, no single-partition windows."""

from barflow.operators import explore as ex
from barflow.sources import bars as src
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_filter_pushed_to_scan(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    p = _plan(ex.date_range(li, "1995-01-01", "1995-12-31", order="l_shipdate").select("l_orderkey"))
    assert "PushedFilters" in p and "l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_bar_build_reads_only_needed_columns(spark):
    p = _plan(src.ord_bars(spark, SF_SMALL))
    assert "o_custkey" not in p and "o_orderstatus" not in p


def test_bar_build_partial_aggregation(spark):
    p = _plan(src.lin_bars(spark, SF_SMALL))
    assert "partial_sum" in p  # map-side combine before the shuffle


def test_no_global_window_in_sequences(spark):
    from barflow.operators import sequences as sq

    p = _plan(sq.lookback_sequences(src.lin_bars(spark, SF_SMALL), "close", 5))
    assert "SinglePartition" not in p
