"""Edge cases: calendar days, NULL keys, short and constant series, deep frames, sessions without a shared folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barflow import session
from barflow.operators import explore, halo, quality, tsa
from barflow.operators import indicators as ind


def _series(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, close double")


@pytest.fixture(scope="module")
def mixed(spark):
    """A normal series beside constant, 1-, 2- and 3-bar ones and one without a symbol."""
    import random

    rnd = random.Random(3)
    day = lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i)
    walk = [100.0]
    for _ in range(119):
        walk.append(walk[-1] + rnd.gauss(0, 1))
    rows = [("N", day(i), v) for i, v in enumerate(walk)] + [(None, day(i), v + 5) for i, v in enumerate(walk)]
    rows += [("C", day(i), 7.0) for i in range(60)]
    rows += [(f"S{n}", day(i), 3.0 + i * i) for n in (1, 2, 3) for i in range(n)]
    return _series(spark, rows)


@pytest.mark.parametrize("d", [0, 1])
def test_acf_and_pacf_of_odd_series(mixed, d):
    a = tsa.acf(mixed, nlags=5, d=d)
    got = {(r.symbol, r.lag): r.acf for r in a.collect()}
    assert got[("N", 0)] == 1.0 and got[(None, 0)] == 1.0 and got[("C", 1)] is None
    assert got[("N", 3)] == pytest.approx(got[(None, 3)])
    p = {(r.symbol, r.lag): r.pacf for r in tsa.pacf(a).collect()}
    assert p[("C", 1)] is None and p[("N", 1)] == pytest.approx(got[("N", 1)])


def test_adf_of_odd_series(mixed):
    zero = {r.symbol: r for r in tsa.adf_lag0(mixed).collect()}
    assert zero["C"].adf_stat is None and zero["S1"].adf_stat is None and zero["S2"].adf_stat is None
    assert zero["N"].adf_stat == pytest.approx(zero[None].adf_stat)
    auto = {r.symbol: r for r in tsa.adf(mixed).collect()}
    assert auto["C"].adf_stat is None and auto["C"].p_bracket is None
    assert auto["N"].adf_stat is not None and auto["N"].p_bracket in ("<1%", "1-5%", "5-10%", ">10%")


def test_arma_of_odd_series(mixed):
    coefs = {(r.symbol, r.term): r.coef for r in tsa.arma_fit(mixed, order=(1, 1, 0)).collect()}
    assert coefs.get(("C", "ar.L1")) is None and coefs[("N", "ar.L1")] is not None
    assert coefs[("N", "ar.L1")] == pytest.approx(coefs[(None, "ar.L1")])
    inside = tsa.arma_predict(mixed.where("symbol = 'N'"), order=(2, 1, 2), start=10, end=99)
    assert inside.count() == 90  # from position 10 on, with a shorter residual history


def test_forecast_of_hourly_bars_steps_by_the_hour(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", t0 + dt.timedelta(hours=i), float(100 + (i * 7) % 13 + i * 0.1)) for i in range(120)]
    bars = spark.createDataFrame(rows, "symbol string, bar_ts timestamp, close double")
    got = tsa.arma_forecast(bars, order=(1, 1, 0), horizon=3, date="bar_ts").orderBy("step").collect()
    assert [r.bar_ts for r in got] == [t0 + dt.timedelta(hours=119 + h) for h in (1, 2, 3)]


def test_date_range_takes_whole_days(spark):
    t = dt.datetime
    rows = [(t(2024, 1, d, h),) for d in (8, 9, 10, 11) for h in (0, 12, 23)]
    frame = spark.createDataFrame(rows, "date timestamp_ntz")
    assert explore.date_range(frame, "2024-01-09", "2024-01-10").count() == 6
    assert explore.date_range(frame, dt.date(2024, 1, 9), dt.date(2024, 1, 10)).count() == 6
    assert explore.date_range(frame, None, t(2024, 1, 10, 12)).count() == 8
    assert explore.date_range(frame.select(F.col("date").cast("date").alias("date")), "2024-01-09", "2024-01-10").count() == 6


def test_null_keys_stay_in_the_quality_report(spark):
    rows = [("A", dt.date(2020, 1, 1), 1.0), (None, dt.date(2020, 1, 1), None), (None, dt.date(2020, 1, 1), 2.0)]
    got = {r.symbol: r for r in quality.quality_rules(_series(spark, rows)).collect()}
    assert got[None].n_rows == 2 and got[None].dup_key_rows == 1 and got[None].null_close == 1


def test_frames_deeper_than_a_block(spark):
    rows = [("A", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(6000)]
    got = ind.moving_averages(_series(spark, rows), (5000,)).where("date = '2016-06-04'").first()
    assert got.ma_5000 == pytest.approx(sum(range(1000, 6000)) / 5000)
    assert halo.core(halo.blocked(_series(spark, rows), preceding=9000)).count() == 6000


def test_quartiles_exact_and_approximate(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(300)] + [("A", dt.date(2020, 12, 1), 1e6)]
    frame = _series(spark, rows)
    exact, near = explore.quartiles(frame).first(), explore.quartiles(frame, accuracy=100).first()
    assert exact.median == 150.0 and abs(near.median - 150.0) <= 4
    assert [r.close for r in explore.box_outliers(frame).collect()] == [1e6]


def test_no_made_up_checkpoint_folder(spark):
    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
