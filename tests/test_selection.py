"""Exact order statistics by refinement, and wide correlations."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import explore as ex
from barflow.operators import selection


def _values(seed=3):
    rnd = np.random.default_rng(seed)
    series = {"wild": np.concatenate([rnd.normal(size=700) * 10.0 ** rnd.integers(-9, 9, 700), [1e12, -1e12, 0.0]]),
              "copies": np.repeat([1.0, 2.0, 2.0, 5.0], 300), "few": np.array([3.0, 1.0]), None: rnd.normal(size=900), "one": np.array([4.0]), "flat": np.full(400, 7.0)}
    return pd.DataFrame([(k, float(v)) for k, x in series.items() for v in x], columns=["symbol", "x"])


@pytest.mark.parametrize("bound, buckets", [(1, 512), (10_000, 1024)])
def test_ranks_equal_sorting(spark, bound, buckets):
    pdf = _values()
    df = spark.createDataFrame(pdf).repartition(5)
    own = {k: np.sort(pdf["x"][pdf["symbol"].isna() if k is None else pdf["symbol"] == k].to_numpy()) for k in pdf["symbol"].unique()}
    wanted = [(k, int(r)) for k, x in own.items() for r in {0, 1, len(x) // 3, len(x) // 2, len(x) - 1, len(x), -1}]
    got = selection.select_ranks(df, spark.createDataFrame(wanted, "symbol string, rank long"), ["symbol"], "x", bound, buckets).collect()
    assert {(r.symbol, r["rank"]): r.value for r in got} == {(k, r): own[k][r] for k, r in wanted if 0 <= r < len(own[k])}


def test_percentiles_equal_the_aggregate(spark):
    df = spark.createDataFrame(_values(8)).union(spark.createDataFrame([("few", None), ("none", None)], "symbol string, x double"))
    shares = (0.0, 0.25, 0.5, 0.9, 1.0)
    want = df.where("x is not null").groupBy("symbol").agg(F.percentile("x", F.array(*map(F.lit, shares))).alias("q"))
    got = {r.symbol: r.q for r in selection.exact_percentiles(df, ["symbol"], "x", shares, bound=16).collect()}
    assert len(got) == 6
    for r in want.collect():
        assert np.allclose(got[r.symbol], r.q, rtol=1e-12)


def test_box_stats_with_a_bound(spark):
    pdf = _values(5).dropna()
    pdf = pdf[pdf["symbol"] != "wild"].assign(date=pd.Timestamp("2020-05-01").date())
    df = spark.createDataFrame(pdf).withColumnRenamed("x", "close")
    assert sorted(map(tuple, ex.box_stats(df).collect())) == sorted(map(tuple, ex.box_stats(df, bound=8).collect()))
    whole = ex.box_stats(df, keys=(), by="all", bound=8).collect()
    assert len(whole) == 1 and whole[0].n == len(pdf)


def test_no_task_gets_a_whole_group(spark):
    """The only lists that are made hold at most ``bound`` values."""
    df = spark.range(50_000).select(F.lit("a").alias("g"), F.sqrt("id").alias("x"))
    q = selection.exact_percentiles(df, ["g"], "x", (0.5,), bound=64)
    plan = q._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan
    assert q.first().q[0] == pytest.approx((np.sqrt(24_999) + np.sqrt(25_000)) / 2)


def test_wide_correlation_equals_pandas(spark):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(400, 300)) @ rnd.normal(size=(300, 300)) + 1e4
    x[rnd.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.0
    pdf = pd.DataFrame(x, columns=[f"m{i}" for i in range(300)])
    got = ex.corr_wide(spark.createDataFrame(pdf).repartition(3), list(pdf.columns), columns=77).toPandas()
    assert len(got) == 300 * 299 // 2
    want = pdf.corr().to_numpy()
    a, b = (got[c].str[1:].astype(int).to_numpy() for c in ("col_a", "col_b"))
    flat = (a == 7) | (b == 7)
    assert got["corr"][flat].isna().all()
    assert np.allclose(got["corr"].to_numpy()[~flat], want[a, b][~flat], atol=1e-9)


def test_ranks_at_the_ends_of_the_range(spark):
    x = [1.7e308, -1.7e308, 0.0, 5e-324, 1.0]
    df = spark.createDataFrame([("a", v) for v in x], "g string, x double")
    got = selection.select_ranks(df, spark.createDataFrame([("a", r) for r in range(5)], "g string, rank long"), ["g"], "x", bound=4, buckets=1024).collect()
    assert [r.value for r in sorted(got, key=lambda r: r["rank"])] == sorted(x)
