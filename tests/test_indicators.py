"""Hand-checked micro series (FIXTURES.md) and indicator semantics."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barflow.operators import indicators as ind
from barflow.operators import scale as sc


def _bars(spark, closes, symbol="S"):
    d0 = dt.date(2020, 1, 1)
    rows = [(symbol, d0 + dt.timedelta(days=i), c, c + 1.0, c - 1.0, float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(pd.DataFrame(rows, columns=["symbol", "date", "open", "high", "low", "close"]))


def test_rsi_rising_then_dip(spark):
    out = ind.rsi(_bars(spark, [10, 11, 12, 11, 13]), 14).orderBy("date").toPandas()
    r = out["rsi"].tolist()
    assert r[0] is None or pd.isna(r[0])
    assert pd.isna(r[1]) and pd.isna(r[2])
    assert r[3] == pytest.approx(66.6667, abs=1e-3)
    assert r[4] == pytest.approx(80.0, abs=1e-9)


def test_bollinger_first_row_null(spark):
    out = ind.bollinger(_bars(spark, [10, 11, 12, 11, 13]), 20).orderBy("date").toPandas()
    assert pd.isna(out["std_20"].iloc[0])
    assert out["ma_20"].iloc[0] == 10


def test_constant_series(spark):
    b = _bars(spark, [7, 7, 7])
    assert ind.rsi(b, 14).toPandas()["rsi"].isna().all()
    st = ind.stochastic(b.withColumns({"high": b.close, "low": b.close}), 14, "minmax").toPandas()
    assert st["stoch_osc"].isna().all()
    stats = sc.fit_minmax(b, ["close"])
    scaled = sc.apply_minmax(b, stats, ["close"]).toPandas()
    assert (scaled["close_scaled"] == 0.5).all()


def test_partial_warmup_frames(spark):
    out = ind.moving_averages(_bars(spark, [1, 2, 3, 4]), (2, 50)).orderBy("date").toPandas()
    assert out["ma_50"].tolist() == [1.0, 1.5, 2.0, 2.5]
    assert out["ma_2"].tolist() == [1.0, 1.5, 2.5, 3.5]


@pytest.mark.parametrize("kind", ["double", "decimal(12,2)", "bigint"])
def test_deep_frames_are_added_up_from_parts(spark, kind):
    """Equal to the plain frame over block edges, and no frame of that depth slides (Spark would read all its rows again for each row)."""
    n, rnd = 300, np.random.default_rng(5)
    rows = [(s, i, float(rnd.integers(-500, 500))) for s, m in (("A", 1500), (None, 601), ("B", 299), ("C", 1)) for i in range(m)]
    rows = [(s, i, None if i % 7 == 0 or 700 < i < 1100 else x) for s, i, x in rows]
    df = spark.createDataFrame(rows, "symbol string, i long, x double").withColumn("x", F.col("x").cast(kind))
    if kind == "double":  # odd values show in their own frames only
        odd = {5: 1e300, 350: float("inf"), 1150: float("nan")}
        df = df.withColumn("x", F.coalesce(*[F.when((F.col("symbol") == "A") & (F.col("i") == i), F.lit(v)) for i, v in odd.items()], "x"))
    out = ind.moving_averages(df, (3, n), "x", order="i", block=128)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert f"RowFrame, -{n - 1}, currentrow" not in plan and "RowFrame, -2, currentrow" in plan
    w = Window.partitionBy("symbol").orderBy("i")
    want = df.withColumns({f"ma_{k}": F.avg("x").over(w.rowsBetween(1 - k, 0)) for k in (3, n)})
    assert out.schema["ma_300"].dataType == want.schema["ma_300"].dataType and set(out.columns) == set(want.columns)
    a, b = (sorted(f.select("symbol", "i", "ma_3", "ma_300").collect(), key=lambda r: (r[0] or "", r[1])) for f in (out, want))
    assert len(a) == len(rows) and [x[:3] for x in a if x[2] == x[2]] == [x[:3] for x in b if x[2] == x[2]]
    for x, y in zip(a, b):
        assert (x[3] is None) == (y[3] is None) and (x[3] is None or float(x[3]) == pytest.approx(float(y[3]), rel=1e-12, abs=1e-9, nan_ok=True)), (x, y)


def test_feature_build_one_window_exchange(spark):
    from tests.conftest import SF_SMALL
    from barflow.sources import bars as src

    f = ind.technical_features(src.ord_bars(spark, SF_SMALL))
    plan = f._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan  # no un-partitioned window
    assert plan.count("Window") >= 2
