"""Blocked linear recurrences and ARMA residuals against loops over the whole series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import halo, models, tsa
from barflow.operators import recurrence as rec
from barflow.session import scratch_path
from tests.test_tsa import _frame


def _loop(x, coefs, start=None):
    y = [*(start[::-1] if start is not None else np.zeros(len(coefs)))]
    for v in x:
        y.append(v - sum(c * y[-1 - j] for j, c in enumerate(coefs)))
    return np.array(y[len(coefs):])


@pytest.mark.parametrize("q, n", [(1, 1), (1, 500), (3, 2), (3, 64), (6, 333), (0, 5)])
def test_run_equals_loop(q, n):
    rnd = np.random.default_rng(q * 1000 + n)
    coefs = rec.shrink_to_invertible(rnd.normal(size=q))
    x, start = rnd.normal(size=(n, 2)), rnd.normal(size=(q, 2))
    got = rec.run(x, coefs, start)
    for k in range(2):
        assert np.allclose(got[:, k], _loop(x[:, k], coefs, start[:, k]), atol=1e-9)


def test_shrink():
    assert rec.shrink_to_invertible(np.array([0.5])).tolist() == [0.5]
    assert abs(rec.shrink_to_invertible(np.array([-3.0]))[0]) == pytest.approx(0.98)
    assert np.abs(np.linalg.eigvals(rec.companion(rec.shrink_to_invertible(np.array([1.5, -2.0, 0.3]))))).max() == pytest.approx(0.98)


def test_scan_over_blocks_equals_loop(spark):
    """A long series over many blocks, a short one and one without a name; the first inputs are missing."""
    rnd = np.random.default_rng(6)
    sizes = {"long": 1000, "one": 1, None: 37}
    rows = [(s, i, None if i < 2 else float(x)) for s, n in sizes.items() for i, x in enumerate(rnd.normal(size=n))]
    coefs = {"long": (0.6, -0.2), "one": (0.1, 0.1), None: (-0.9, 0.05)}
    df = spark.createDataFrame([(*r, *coefs[r[0]]) for r in rows], "symbol string, date int, x double, c1 double, c2 double")
    placed = halo.core(halo.blocked(df, ["symbol"], "date", block_rows=50))
    assert placed.select(halo.BLK).distinct().count() == 20
    got = rec.scan(placed, {"y": "x"}, ["c1", "c2"], ["symbol"]).toPandas().sort_values("date")
    for s, n in sizes.items():
        own = got[got["symbol"].isna() if s is None else got["symbol"] == s]
        x = [v for k, _, v in rows if k == s][2:]
        assert own["y"].isna().sum() == min(2, n)
        assert np.allclose(own["y"].to_numpy()[2:], _loop(x, coefs[s]), atol=1e-9)


def _arma(n, ar, ma, seed, const=0.0):
    e = np.random.default_rng(seed).normal(size=n + 100)
    x = np.zeros(n + 100)
    for t in range(2, n + 100):
        x[t] = const + ar * x[t - 1] + e[t] + ma * e[t - 1]
    return x[100:]


def _css(x, coef, p, q):
    """Residuals of a model by a plain loop, zero before the first."""
    e = np.zeros(len(x))
    for t in range(p, len(x)):
        e[t] = x[t] - coef[0] - sum(coef[i] * x[t - i] for i in range(1, p + 1)) - sum(coef[p + j] * e[t - j] for j in range(1, q + 1) if t - j >= p)
    return e


def test_residuals_and_predictions_are_the_models_own(spark):
    x = _arma(700, 0.5, 0.4, 3) + 10
    df = _frame(spark, {"a": x, "short": x[:30]})
    fit = tsa.arma_fit(df, "close", (2, 0, 2), wide_form=True)
    coef = {r["symbol"]: [r[c] for c in ("const", "ar_L1", "ar_L2", "ma_L1", "ma_L2")] for r in fit.collect()}
    got = tsa.arma_predict(df, "close", (2, 0, 2), models=fit, block_rows=64).toPandas().sort_values("date")
    for s, series in (("a", x), ("short", x[:30])):
        own = got[got["symbol"] == s]
        want = series - _css(series, coef[s], 2, 2)
        assert len(own) == len(series) - 2 and np.allclose(own["prediction"].to_numpy(), want[2:], atol=1e-8)


def test_refining_comes_nearer_to_least_squares(spark):
    series = {f"s{k}": _arma(1500, 0.5, 0.6, 20 + k, const=1.0) for k in range(3)}
    df = _frame(spark, {**series, "flat": np.full(40, 5.0)})
    wide = [{r["symbol"]: [r[c] for c in ("const", "ar_L1", "ma_L1")] for r in tsa.arma_fit(df, "close", (1, 0, 1), wide_form=True, refine=k).collect()} for k in (0, 2)]
    assert set(wide[0]) == set(wide[1]) >= set(series)  # a constant series has no long autoregression and so no model
    for s, x in series.items():
        first, refined = (sum(_css(x, w[s], 1, 1)[1:] ** 2) for w in wide)
        assert refined <= first * (1 + 1e-9)
        near = [sum(_css(x, np.array(wide[1][s]) + d, 1, 1)[1:] ** 2) for d in 0.02 * np.vstack([np.eye(3), -np.eye(3)])]
        assert refined < min(near)  # a minimum of the model's sum of squares


def test_long_series_is_spread(spark):
    df = _frame(spark, {"a": _arma(900, 0.3, 0.3, 1)})
    fit = spark.createDataFrame([("a", 0.0, 0.3, 0.3)], "symbol string, const double, ar_L1 double, ma_L1 double")
    e = tsa.arma_residuals(df, fit, "close", (1, 0, 1), block_rows=100)
    assert e.groupBy(halo.BLK).count().agg(F.max("count")).first()[0] <= 100 and e.select(halo.BLK).distinct().count() == 9


def test_models_by_version(spark):
    path = scratch_path(spark, "t-models")
    assert models.versions(spark, path) == []
    with pytest.raises(ValueError):
        models.load_models(spark, path)
    frames = [spark.createDataFrame(pd.DataFrame({"symbol": ["a", "b"], "const": [v, 2 * v]})) for v in (1.0, 5.0)]
    assert [models.save_models(f, path) for f in frames] == [1, 2]
    assert {r["const"] for r in models.load_models(spark, path).collect()} == {5.0, 10.0}
    assert {r["const"] for r in models.load_models(spark, path, 1).collect()} == {1.0, 2.0}
    assert {(r.symbol, r.old, r.new) for r in models.compare_versions(spark, path, ("symbol",), "const", 1, 2).collect()} == {("a", 1.0, 5.0), ("b", 2.0, 10.0)}
    with pytest.raises(ValueError):
        models.load_models(spark, path, 9)


def test_fits_are_invertible(spark):
    """An over-differenced short series asks for a moving average beyond the unit circle; predictions stay near the series."""
    x = np.random.default_rng(12).normal(size=60)
    df = _frame(spark, {f"s{k}": x[k : k + 40] + 5 for k in range(20)})
    fit = tsa.arma_fit(df, "close", (1, 1, 1), ar_long=1, wide_form=True)
    assert all(abs(r["ma_L1"]) <= 0.98 + 1e-12 for r in fit.collect())
    got = tsa.arma_predict(df, "close", (1, 1, 1), models=fit).toPandas()
    assert len(got) == 20 * 38 and (got["prediction"] - 5).abs().max() < 50
