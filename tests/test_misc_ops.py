"""Stacking solve, forecast calendars, reference-layout CSV reader."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest

from barflow.functions.dates import future_dates
from barflow.operators import ensemble as en
from barflow.operators import explore
from barflow.session import scratch_path
from barflow.sources import io


def test_stack_fit_matches_lstsq(spark):
    rng = np.random.default_rng(11)
    n = 300
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = 1.5 + 0.8 * a - 0.3 * b + rng.normal(scale=0.1, size=n)
    pdf = pd.DataFrame({"symbol": "S", "a": a, "b": b, "y": y})
    c = en.stack_fit(spark.createDataFrame(pdf), "y", ["a", "b"]).toPandas().iloc[0]
    X = np.column_stack([np.ones(n), a, b])
    ref, *_ = np.linalg.lstsq(X, y, rcond=None)
    assert np.allclose([c.c0, c.c1, c.c2], ref, atol=1e-8)


def test_future_dates_business_days(spark):
    df = spark.createDataFrame(pd.DataFrame({"symbol": ["S"], "date": [dt.date(2022, 2, 4)]}))  # a Friday
    f = future_dates(df, 6, skip_weekends=True).orderBy("step").toPandas()
    assert f["date"].tolist() == [dt.date(2022, 2, d) for d in (7, 8, 9, 10, 11, 14)]
    cal = future_dates(df, 3).orderBy("step").toPandas()
    assert cal["date"].tolist() == [dt.date(2022, 2, 5), dt.date(2022, 2, 6), dt.date(2022, 2, 7)]


def test_read_reference_layout_csv(spark):
    base = scratch_path(spark, "t-ref-csv").replace("file:", "")
    os.makedirs(base, exist_ok=True)
    with open(os.path.join(base, "bars.csv"), "w") as fh:
        fh.write("Date,Open,High,Low,Close,Adj Close,Volume\n")
        fh.write("2018-02-05,262.0,267.899994,250.029999,254.259995,254.259995,11896100\n")
        fh.write("2018-02-06,247.699997,266.700012,245.0,265.720001,265.720001,12595800\n")
        fh.write("not-a-date,1,2,3,4,5,6\n")
    df = io.read_bars_csv(spark, base, symbol="NFLX")
    rows = df.orderBy("date").collect()
    assert [f.name for f in df.schema.fields] == ["symbol", "date", "open", "high", "low", "close", "adj_close", "volume"]
    assert rows[0].date is None  # malformed date kept as NULL (PERMISSIVE), not an error
    assert rows[1].date == dt.date(2018, 2, 5) and rows[1].volume == 11896100
    assert rows[2].adj_close == pytest.approx(265.720001)


def test_feature_columns_and_float_sequences(spark):
    from barflow.operators import sequences as sq
    from barflow.sources.schema import feature_columns

    df = spark.createDataFrame(pd.DataFrame({"symbol": ["S"] * 4, "date": [dt.date(2020, 1, d) for d in range(1, 5)],
                                             "close": [1.0, 2.0, 3.0, 4.0], "volume": [1, 2, 3, 4], "_idx": [0, 1, 2, 3]}))
    assert feature_columns(df) == ["volume"]
    s = sq.lookback_sequences(df, "close", 2, dtype="float")
    assert s.schema["x"].dataType.simpleString() == "array<float>"
    assert s.count() == 2


def test_empty_result_after_a_date_filter(spark):
    bars = spark.createDataFrame([("a", dt.date(2024, 1, 2)), ("a", dt.date(2024, 1, 3))], "symbol string, date date")
    assert explore.is_empty(explore.date_range(bars, "2024-02-01", "2024-02-28"))
    assert not explore.is_empty(explore.date_range(bars, "2024-01-03", "2024-02-28"))
