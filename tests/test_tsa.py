"""Time-series statistics: ACF/PACF identities, ADF verdicts, ARMA recovery."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barflow.operators import tsa


def _frame(spark, series: dict[str, np.ndarray]):
    rows = []
    for s, x in series.items():
        for i, v in enumerate(x):
            rows.append((s, dt.date(2000, 1, 1) + dt.timedelta(days=i), float(v)))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["symbol", "date", "close"]))


def _ar1(n, phi, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = phi * x[t - 1] + e[t]
    return x + 50


@pytest.fixture(scope="module")
def sims(spark):
    walk = np.cumsum(np.random.default_rng(3).normal(size=800)) + 100
    return _frame(spark, {"ar1": _ar1(800, 0.6, 1), "walk": walk})


def test_acf_matches_numpy(spark, sims):
    a = tsa.acf(sims, "close", 10).toPandas()
    x = sims.where(F.col("symbol") == "ar1").orderBy("date").toPandas()["close"].to_numpy()
    z = x - x.mean()
    ref = [np.sum(z[k:] * z[: len(z) - k]) / np.sum(z * z) for k in range(11)]
    got = a[a.symbol == "ar1"].sort_values("lag")["acf"].to_numpy()
    assert np.allclose(got, ref, atol=1e-10)
    assert got[0] == pytest.approx(1.0)


def test_pacf_lag1_equals_acf_lag1(spark, sims):
    a = tsa.acf(sims, "close", 5)
    p = tsa.pacf(a).toPandas()
    ap = a.toPandas()
    for s in ("ar1", "walk"):
        assert p[(p.symbol == s) & (p.lag == 1)]["pacf"].iloc[0] == pytest.approx(
            ap[(ap.symbol == s) & (ap.lag == 1)]["acf"].iloc[0])
    # AR(1): partial autocorrelation cuts off after lag 1
    ar = p[(p.symbol == "ar1") & (p.lag >= 2)]["pacf"].abs()
    assert (ar < 0.15).all()


def test_adf_verdicts(spark, sims):
    r = tsa.adf(sims, "close").toPandas().set_index("symbol")
    assert bool(r.loc["ar1", "stationary_5"]) is True
    assert bool(r.loc["walk", "stationary_5"]) is False
    assert r.loc["ar1", "crit_5"] == pytest.approx(-2.8654, abs=2e-3)


def test_adf_lag0_matches_numpy(spark, sims):
    r = tsa.adf_lag0(sims, "close").toPandas().set_index("symbol")
    x = sims.where(F.col("symbol") == "walk").orderBy("date").toPandas()["close"].to_numpy()
    y, dy = x[:-1], np.diff(x)
    X = np.column_stack([np.ones_like(y), y])
    beta, res, *_ = np.linalg.lstsq(X, dy, rcond=None)
    s2 = res[0] / (len(dy) - 2)
    se = np.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1])
    assert r.loc["walk", "adf_stat"] == pytest.approx(beta[1] / se, rel=1e-6)


def test_arma_recovers_ar1(spark, sims):
    c = tsa.arma_fit(sims.where(F.col("symbol") == "ar1"), "close", (1, 0, 1)).toPandas().set_index("term")
    assert c.loc["ar.L1", "coef"] == pytest.approx(0.6, abs=0.1)
    assert abs(c.loc["ma.L1", "coef"]) < 0.15


def test_forecast_shape_and_dates(spark, sims):
    f = tsa.arma_forecast(sims, "close", (2, 1, 1), 30).toPandas()
    assert len(f) == 60
    last = dt.date(2000, 1, 1) + dt.timedelta(days=799)
    g = f[f.symbol == "walk"].sort_values("step")
    assert g["date"].iloc[0] == last + dt.timedelta(days=1)
    assert g["step"].tolist() == list(range(1, 31))
    assert np.isfinite(g["forecast"]).all()


def test_order_grid_has_one_best_per_symbol(spark, sims):
    g = tsa.arma_order_grid(sims, "close", range(1, 3), range(1, 3)).toPandas()
    assert len(g) == 8
    assert g.groupby("symbol")["best"].sum().tolist() == [1, 1]


def _adf_bruteforce(x: np.ndarray):
    """Textbook ADF with constant: AIC over 0..maxlag on a common sample, refit on all usable rows."""
    n = len(x)
    maxlag = min(n // 2 - 2, int(np.ceil(12.0 * (n / 100.0) ** 0.25)))
    dx = np.diff(x)

    def design(p, start):
        rows = range(start, len(dx))
        X = np.array([[1.0, x[t]] + [dx[t - j] for j in range(1, p + 1)] for t in rows])
        y = np.array([dx[t] for t in rows])
        return X, y

    best = None
    for p in range(maxlag + 1):
        X, y = design(p, maxlag)
        beta, *_ = np.linalg.lstsq(X, y, rcond=None)
        ssr = float(np.sum((y - X @ beta) ** 2))
        m = len(y)
        aic = m * (np.log(2 * np.pi) + np.log(ssr / m) + 1) + 2 * X.shape[1]
        if best is None or aic < best[0]:
            best = (aic, p)
    p = best[1]
    X, y = design(p, p)
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    resid = y - X @ beta
    s2 = resid @ resid / (len(y) - X.shape[1])
    se = np.sqrt(s2 * np.linalg.inv(X.T @ X)[1, 1])
    return beta[1] / se, p, len(y)


def test_adf_matches_bruteforce(spark, sims):
    r = tsa.adf(sims, "close").toPandas().set_index("symbol")
    for s in ("ar1", "walk"):
        x = sims.where(F.col("symbol") == s).orderBy("date").toPandas()["close"].to_numpy()
        stat, lag, nobs = _adf_bruteforce(x)
        assert int(r.loc[s, "used_lag"]) == lag
        assert int(r.loc[s, "n_obs"]) == nobs
        assert r.loc[s, "adf_stat"] == pytest.approx(stat, rel=1e-6)


def test_arma11_recovery(spark):
    rng = np.random.default_rng(21)
    n, phi, theta = 3000, 0.6, 0.3
    e = rng.normal(size=n)
    x = np.zeros(n)
    for t in range(1, n):
        x[t] = phi * x[t - 1] + e[t] + theta * e[t - 1]
    df = _frame(spark, {"arma": x + 10})
    c = tsa.arma_fit(df, "close", (1, 0, 1)).toPandas().set_index("term")
    assert c.loc["ar.L1", "coef"] == pytest.approx(phi, abs=0.08)
    assert c.loc["ma.L1", "coef"] == pytest.approx(theta, abs=0.08)
    assert c.loc["const", "sigma2"] == pytest.approx(1.0, abs=0.1)


def test_pacf_matches_yule_walker_bruteforce(spark, sims):
    a = tsa.acf(sims, "close", 12)
    p = tsa.pacf(a).toPandas()
    ap = a.toPandas()
    r = ap[ap.symbol == "walk"].sort_values("lag")["acf"].to_numpy()
    got = p[p.symbol == "walk"].sort_values("lag")["pacf"].to_numpy()
    for k in range(1, 13):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(toeplitz, r[1:k + 1])
        assert got[k] == pytest.approx(phi[-1], abs=1e-8)


def test_dickey_fuller_surface_against_published_points():
    """The simulated quantiles against MacKinnon (2010), and in order for every sample size."""
    from barflow.operators import dickey_fuller as dfu

    for n in (25, 50, 100, 250, 1000, 10**6):
        crit = tsa.adf_critical(n)
        for level, p in (("1%", 0.01), ("5%", 0.05), ("10%", 0.1)):
            assert abs(dfu.quantile(p, n) - crit[level]) < 0.02, (n, level)
    for n in [*range(1, 60), 100, 1000, 10**7]:
        q = [dfu.quantile(p, n) for p in sorted(dfu.SURFACE)]
        assert q == sorted(q)


def test_dickey_fuller_p_values(spark):
    from barflow.operators import dickey_fuller as dfu

    rows = [(n, p, dfu.quantile(p, n)) for n in (5, 30, 400) for p in dfu.SURFACE] + [(50, None, None), (50, 0.0, -60.0), (50, 1.0, 40.0)]
    got = spark.createDataFrame(rows, "n long, p double, s double").withColumn("got", dfu.p_value(F.col("s"), F.col("n"))).collect()
    for r in got:
        assert (r.got is None) if r.p is None else abs(r.got - r.p) < 1e-9 or r.p in (0.0, 1.0) and abs(r.got - r.p) < 1e-4 and 0 <= r.got <= 1
    line = spark.range(-80, 30).selectExpr("id / 10 AS s", "60L AS n").withColumn("p", dfu.p_value(F.col("s"), F.col("n"))).orderBy("s").collect()
    assert all(a.p < b.p for a, b in zip(line, line[1:]))


def test_dickey_fuller_simulation_is_seeded_and_fits(spark):
    from barflow.operators import dickey_fuller as dfu

    sizes = {30: 40_000, 60: 40_000, 120: 40_000, 240: 30_000}
    tables = [dfu.quantiles(dfu.simulate(spark, sizes, seed=5), (0.05, 0.5)).collect() for _ in range(2)]
    assert sorted(tables[0]) == sorted(tables[1]) and len(tables[0]) == 8
    for r in tables[0]:
        assert abs(r.quantile - dfu.quantile(r.probability, r["size"])) < 0.05


def test_p_values_of_walks_are_uniform(spark):
    """Under a unit root p-values below x come in a share of x."""
    rnd = np.random.default_rng(8)
    walks = pd.DataFrame([(f"w{k}", i, v) for k in range(300) for i, v in enumerate(np.cumsum(rnd.standard_normal(60)))], columns=["symbol", "date", "close"])
    p = tsa.adf_lag0(spark.createDataFrame(walks)).toPandas()["p_value"]
    assert len(p) == 300 and abs((p < 0.1).mean() - 0.1) < 0.06 and abs((p < 0.5).mean() - 0.5) < 0.1
