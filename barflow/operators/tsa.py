"""Time-series statistics per symbol: ACF, PACF, ADF, least-squares ARMA, forecasts.

Data passes are Spark jobs on the halo layout (lag columns) followed by grouped
sums; per-symbol work that remains (Durbin-Levinson over 41 numbers, k x k
solves, a 30-step recursion) runs in pandas on tables with one row, or a few
rows, per symbol.

ARMA is fitted by Hannan-Rissanen least squares (long autoregression ->
residuals -> regression on lagged values and lagged residuals), not by maximum
likelihood, so coefficients differ slightly from a likelihood optimiser's;
``refine`` adds Gauss-Newton steps on the model's own residuals. These residuals,
which in-sample predictions and forecasts go on from, come from the recurrence
``e_t = v_t - const - sum ar_i v_{t-i} - sum ma_j e_{t-j}`` (``recurrence.scan``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow import ensure_importable
from barflow.operators import dickey_fuller as dfu
from barflow.operators import gram as gm
from barflow.operators import halo
from barflow.operators import recurrence as rec

# MacKinnon (2010), Table 2, unit-root test with a constant
# (N = 1): critical value = c0 + c1/T + c2/T^2 + c3/T^3.
ADF_CRIT_CONST = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def adf_critical(n):
    """Critical values for T = n (a Column or a number)."""
    out = {}
    for level, (c0, c1, c2, c3) in ADF_CRIT_CONST.items():
        if isinstance(n, (int, float)):
            out[level] = c0 + c1 / n + c2 / n**2 + c3 / n**3
        else:
            t = F.nullif(n.cast("double"), F.lit(0.0))
            out[level] = F.lit(c0) + F.lit(c1) / t + F.lit(c2) / (t * t) + F.lit(c3) / (t * t * t)
    return out


def _series(df: DataFrame, col: str, keys, order) -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(*keys, order, col)


def _vlag(col: str, k: int, d: int, w):
    """Lag k of the d-times differenced series (d in {0, 1})."""
    cur = F.col(col) if k == 0 else F.lag(col, k).over(w)
    if d == 0:
        return cur
    if d == 1:
        return cur - F.lag(col, k + 1).over(w)
    raise ValueError("d must be 0 or 1")


# ----------------------------------------------------------------------------- ACF / PACF


def acf(df: DataFrame, col: str = "close", nlags: int = 40, d: int = 0, keys: Sequence[str] = ("symbol",),
        order: str = "date", z: float = 1.96, block=None) -> DataFrame:
    """Sample autocorrelation per key, long form ``keys, lag, acf, conf_band, n``.

    ``acf_k = sum_t (v_t - m)(v_{t-k} - m) / sum_t (v_t - m)^2`` over the (d-times
    differenced) series v; ``conf_band`` is z times Bartlett's standard error.
    The mean comes from a narrow aggregate of the input (for d = 1 the
    differences telescope to ``(last - first) / (n - 1)``), so the lag window
    runs once.
    """
    keys = list(keys)
    s = _series(df, col, keys, order)
    if d == 0:
        mean = s.groupBy(*keys).agg(F.avg(col).alias("_m"), F.count(F.lit(1)).alias("n"))
    elif d == 1:
        cnt = F.count(F.lit(1)) - 1
        mean = s.groupBy(*keys).agg(
            F.try_divide(F.max_by(col, order) - F.min_by(col, order), cnt).alias("_m"), cnt.alias("n")
        )
    else:
        raise ValueError("d must be 0 or 1")
    h = halo.blocked(halo.join_null_safe(s, mean, keys), keys, order, preceding=nlags + d, block=block)
    w = halo.block_window(keys)
    lagged = [F.lag(col, k).over(w) for k in range(1, nlags + d + 1)]  # one window node, plain lags
    h = halo.core(h.select(*keys, "_m", "n", F.col(col).alias("_x0"),
                           *[c.alias(f"_x{k}") for k, c in enumerate(lagged, 1)], halo.BLK, halo.HOME))

    def vk(k):  # lag k of the (differenced) series, centred
        v = F.col(f"_x{k}") if d == 0 else F.col(f"_x{k}") - F.col(f"_x{k + 1}")
        return v - F.col("_m")

    sums = h.groupBy(*keys).agg(
        F.max("n").alias("n"), *[F.sum(vk(0) * vk(k)).alias(f"_s{k}") for k in range(nlags + 1)]
    )
    parts = ", ".join(f"{k}, try_divide(_s{k}, _s0)" for k in range(nlags + 1))
    long = sums.selectExpr(*keys, "n", f"stack({nlags + 1}, {parts}) AS (lag, acf)")
    wl = Window.partitionBy(*keys).orderBy("lag")  # nlags + 1 rows per key
    prev_sq = F.coalesce(
        F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf"))).over(wl.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0.0),
    )
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        F.lit(z) * F.sqrt(F.try_divide(F.lit(1.0) + F.lit(2.0) * prev_sq, F.col("n")))
    )
    return long.select(*keys, F.col("lag").cast("int"), "acf", band.alias("conf_band"), "n")


def _durbin_levinson(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations from autocorrelations r[0..K] (r[0] = 1)."""
    k_max = len(r) - 1
    out = np.zeros(k_max + 1)
    out[0] = 1.0
    if k_max == 0:
        return out
    phi = np.zeros(k_max + 1)
    phi[1] = r[1]
    out[1] = r[1]
    for k in range(2, k_max + 1):
        num = r[k] - np.dot(phi[1:k], r[k - 1:0:-1])
        den = 1.0 - np.dot(phi[1:k], r[1:k])
        pkk = num / den if den != 0 else np.nan
        new = phi.copy()
        new[k] = pkk
        new[1:k] = phi[1:k] - pkk * phi[k - 1:0:-1]
        phi = new
        out[k] = pkk
    return out


def pacf(acf_long: DataFrame, keys: Sequence[str] = ("symbol",), z: float = 1.96) -> DataFrame:
    """PACF by Durbin-Levinson on each key's ACF (Yule-Walker, biased ACF).

    Input is the ``acf`` output (nlags + 1 rows per key); band = z / sqrt(n).
    """
    keys = list(keys)
    schema = ", ".join(f"{k} {acf_long.schema[k].dataType.simpleString()}" for k in keys)
    schema += ", lag int, pacf double, conf_band double, n long"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        vals = _durbin_levinson(pdf["acf"].to_numpy(dtype=float))
        n = int(pdf["n"].iloc[0])
        out = pd.DataFrame({"lag": pdf["lag"].astype("int32").to_numpy(), "pacf": vals})
        out["conf_band"] = np.where(out["lag"] == 0, 0.0, z / math.sqrt(n) if n > 0 else np.nan)
        out["n"] = n
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[[*keys, "lag", "pacf", "conf_band", "n"]]

    ensure_importable(acf_long.sparkSession)
    out = acf_long.groupBy(*keys).applyInPandas(run, schema)
    clean = lambda c: F.when(~F.isnan(c), F.col(c)).alias(c)  # noqa: E731  constant and one-bar series have none
    return out.select(*keys, "lag", clean("pacf"), clean("conf_band"), "n")


# ----------------------------------------------------------------------------- ADF


def adf_lag0(df: DataFrame, col: str = "close", keys: Sequence[str] = ("symbol",), order: str = "date",
             block=None) -> DataFrame:
    """Dickey-Fuller test without augmentation lags (regression with constant).

    ``dy_t = a + b * y_{t-1}``; statistic ``b / se(b)`` from the SQL ``regr_*``
    aggregates; critical values and p-value for T = number of regression rows.
    """
    keys = list(keys)
    h = halo.blocked(_series(df, col, keys, order), keys, order, preceding=1, block=block)
    w = halo.block_window(keys)
    h = halo.core(h.withColumns({"_ylag": F.lag(col, 1).over(w)}).withColumn("_dy", F.col(col) - F.col("_ylag")))
    r = h.groupBy(*keys).agg(
        F.regr_slope("_dy", "_ylag").alias("beta"),
        F.regr_sxx("_dy", "_ylag").alias("_sxx"),
        F.regr_syy("_dy", "_ylag").alias("_syy"),
        F.regr_sxy("_dy", "_ylag").alias("_sxy"),
        F.regr_count("_dy", "_ylag").alias("n"),
    )
    rest = F.col("_syy") - F.try_divide(F.col("_sxy") * F.col("_sxy"), F.col("_sxx"))
    s2 = F.try_divide(rest, F.greatest(F.col("n") - 2, F.lit(0)))  # NULL for constant series and under three rows
    stat = F.try_divide(F.col("beta"), F.sqrt(F.try_divide(s2, F.col("_sxx"))))
    crit = adf_critical(F.col("n"))
    return r.select(
        *keys,
        F.col("n").cast("bigint").alias("n"),
        stat.alias("adf_stat"),
        crit["1%"].alias("crit_1"),
        crit["5%"].alias("crit_5"),
        crit["10%"].alias("crit_10"),
        (stat < crit["5%"]).alias("stationary_5"),
        dfu.p_value(stat, F.col("n")).alias("p_value"),
    )


def default_maxlag(nobs: int) -> int:
    """Schwert's rule 12 * (n / 100)^(1/4), capped so the regression keeps degrees of freedom."""
    return max(0, min(nobs // 2 - 2, int(math.ceil(12.0 * (nobs / 100.0) ** 0.25))))


def adf(df: DataFrame, col: str = "close", keys: Sequence[str] = ("symbol",), order: str = "date",
        maxlag: int | None = None, autolag: str | None = "AIC", block=None) -> DataFrame:
    """Augmented Dickey-Fuller test per key (constant, no trend).

    Lag length by AIC (or BIC) over 0..maxlag on the common sample, then a
    refit with the chosen lag on every row it allows. ``maxlag`` defaults to
    Schwert's rule on each key's length. One lag window and one Gram pass: the
    Gram sums are kept per "sample-start segment" (each of a key's first
    ``cap`` rows alone, the rest together), so every sample the search and the
    refit need is a suffix sum of segments. Output: ``keys, adf_stat, used_lag,
    n_obs, crit_1, crit_5, crit_10, stationary_5, ic_best, p_bracket, p_value``.
    """
    keys = list(keys)
    s = _series(df, col, keys, order)
    if maxlag is None:
        longest = s.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0  # one scalar
        kmax = default_maxlag(int(longest))
    else:
        kmax = int(maxlag)
    h = halo.blocked(s, keys, order, preceding=kmax + 1, block=block)
    w = halo.block_window(keys)
    cols = {"_ylag": F.lag(col, 1).over(w), "_dy0": _vlag(col, 0, 1, w)}
    cols.update({f"_dy{j}": _vlag(col, j, 1, w) for j in range(1, kmax + 1)})
    v = halo.core(h.withColumns(cols))
    n_key = F.col(halo.CNT)
    if maxlag is None:
        cap = F.least(F.floor(n_key / 2) - 2, F.ceil(F.lit(12.0) * F.pow(n_key.cast("double") / 100.0, 0.25)))
    else:
        cap = F.least(F.lit(kmax), F.floor(n_key / 2) - 2)
    v = v.withColumn("_cap", F.greatest(cap, F.lit(0)).cast("int"))
    v = v.withColumn("_seg", F.least(F.col(halo.IDX), F.col("_cap") + 1).cast("int"))
    lags = [
        F.when(F.lit(j) <= F.col("_cap"), F.coalesce(F.col(f"_dy{j}"), F.lit(0.0))).otherwise(F.lit(0.0))
        for j in range(1, kmax + 1)
    ]
    g = gm.gram(v, [*keys, "_cap", "_seg"], [F.lit(1.0), F.col("_ylag"), *lags], F.col("_dy0"),
                where=F.col(halo.IDX) >= 1)
    packed = g.groupBy(*keys, "_cap").agg(F.collect_list(F.struct("_seg", "g", "n")).alias("_segs"))  # <= cap + 2
    k = kmax + 2
    out_schema = ", ".join(f"{c} {v.schema[c].dataType.simpleString()}" for c in keys)
    out_schema += ", adf_stat double, used_lag int, n_obs long, ic_best double"
    crit = (autolag or "").upper()

    def run(batches):
        for pdf in batches:
            rows = []
            for _, r in pdf.iterrows():
                capv = int(r["_cap"])
                segs = {}
                for e in r["_segs"]:
                    xtx, xty, yty = gm.unpack(e["g"], k)
                    segs[int(e["_seg"])] = (xtx, xty, yty, int(e["n"]))

                def suffix(start):
                    parts = [segs[t] for t in segs if t >= start] or [(np.zeros((k, k)), np.zeros(k), 0.0, 0)]
                    return (sum(p_[0] for p_ in parts), sum(p_[1] for p_ in parts), sum(p_[2] for p_ in parts),
                            sum(p_[3] for p_ in parts))

                best = (float("nan"), capv)
                if crit in ("AIC", "BIC"):
                    cxtx, cxty, cyty, cn = suffix(capv + 1)
                    best = None
                    for p in range(0, capv + 1):
                        idx = list(range(2 + p))
                        _, _, ssr = gm.ols_from_gram(cxtx, cxty, cyty, cn, idx)
                        ic = gm.aic_ls(ssr, cn, len(idx))
                        if crit == "BIC":
                            ic = ic - 2 * len(idx) + math.log(max(cn, 1)) * len(idx)
                        if best is None or ic < best[0] or math.isnan(best[0]):
                            best = (ic, p)
                p = best[1]
                xtx, xty, yty, n = suffix(p + 1)
                beta, se, _ = gm.ols_from_gram(xtx, xty, yty, n, list(range(2 + p)))
                stat = float(beta[1] / se[1]) if se[1] > 0 else float("nan")
                rows.append({**{c: r[c] for c in keys}, "adf_stat": stat, "used_lag": p, "n_obs": n,
                             "ic_best": float(best[0])})
            yield pd.DataFrame(rows, columns=[*keys, "adf_stat", "used_lag", "n_obs", "ic_best"])

    ensure_importable(packed.sparkSession)
    res = packed.mapInPandas(run, out_schema)
    crit_v = adf_critical(F.col("n_obs"))
    return res.select(
        *keys, F.when(~F.isnan("adf_stat"), F.col("adf_stat")).alias("adf_stat"), "used_lag", "n_obs",
        crit_v["1%"].alias("crit_1"), crit_v["5%"].alias("crit_5"), crit_v["10%"].alias("crit_10"),
        F.when(~F.isnan("adf_stat"), F.col("adf_stat") < crit_v["5%"]).alias("stationary_5"),
        F.when(~F.isnan("ic_best"), F.col("ic_best")).alias("ic_best"),
        F.when(F.col("adf_stat").isNull() | F.isnan("adf_stat"), F.lit(None)).when(F.col("adf_stat") < crit_v["1%"], F.lit("<1%"))
        .when(F.col("adf_stat") < crit_v["5%"], F.lit("1-5%")).when(F.col("adf_stat") < crit_v["10%"], F.lit("5-10%"))
        .otherwise(F.lit(">10%")).alias("p_bracket"),
        dfu.p_value(F.col("adf_stat"), F.col("n_obs")).alias("p_value"),
    )


# ----------------------------------------------------------------------------- ARMA (Hannan-Rissanen)


def _lags(df: DataFrame, col: str, d: int, depth: int, keys, order, block, block_rows: int = halo.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Core rows with ``_v0.._v{depth}`` (lags of the differenced series) and ``_y1`` (previous level)."""
    h = halo.blocked(_series(df, col, keys, order), keys, order, preceding=max(depth + d, 1), block=block, block_rows=block_rows)
    w = halo.block_window(keys)
    cols = {f"_v{k}": _vlag(col, k, d, w) for k in range(depth + 1)}
    cols["_y1"] = F.lag(col, 1).over(w)
    return halo.core(h.withColumns(cols))


def _wide_coefs(g: DataFrame, keys, k: int, names: Sequence[str], prefix: str, q: int = 0) -> DataFrame:
    """Solve each key's system; one row per key with columns ``{prefix}{name}``, ``_sigma2``, ``_nfit``.

    The last ``q`` coefficients are a moving average; one whose residuals would
    grow without end is shrunk (``recurrence.shrink_to_invertible``).
    """
    schema = ", ".join(f"{c} {g.schema[c].dataType.simpleString()}" for c in keys)
    schema += ", " + ", ".join(f"{prefix}{n} double" for n in names) + ", _sigma2 double, _nfit long"

    def run(batches):
        for pdf in batches:
            rows = []
            for _, r in pdf.iterrows():
                xtx, xty, yty = gm.unpack(r["g"], k)
                n = int(r["n"])
                beta, _, ssr = gm.ols_from_gram(xtx, xty, yty, n)
                beta = np.concatenate([beta[: k - q], rec.shrink_to_invertible(beta[k - q :])])
                row = {c: r[c] for c in keys}
                row.update({f"{prefix}{nm}": float(b) for nm, b in zip(names, beta)})
                row["_sigma2"] = ssr / n if n else float("nan")
                row["_nfit"] = n
                rows.append(row)
            yield pd.DataFrame(rows, columns=[*keys, *[f"{prefix}{n}" for n in names], "_sigma2", "_nfit"])

    ensure_importable(g.sparkSession)
    return g.mapInPandas(run, schema)


def _arma_names(p: int, q: int) -> list[str]:
    return ["const", *[f"ar_L{i}" for i in range(1, p + 1)], *[f"ma_L{j}" for j in range(1, q + 1)]]


def _long_ar_order(p: int, q: int, ar_long: int | None) -> int:
    return ar_long if ar_long else max(10, 2 * max(p, q))


def _with_residual_lags(lagged: DataFrame, keys, m: int, q: int) -> DataFrame:
    """Fit the long AR(m) and add stage-1 residual lags ``_e0.._e{q}``."""
    one = F.lit(1.0)
    names1 = ["c", *[f"a{i}" for i in range(1, m + 1)]]
    g1 = gm.gram(lagged, keys, [one, *[F.col(f"_v{i}") for i in range(1, m + 1)]], F.col("_v0"))
    a = _wide_coefs(g1, keys, m + 1, names1, "_s1_").drop("_sigma2", "_nfit")
    j = halo.join_null_safe(lagged, a, keys)
    res = {}
    for lag in range(q + 1):
        e = F.col(f"_v{lag}") - F.col("_s1_c")
        for i in range(1, m + 1):
            e = e - F.col(f"_s1_a{i}") * F.col(f"_v{lag + i}")
        res[f"_e{lag}"] = e
    return j.withColumns(res).drop(*[f"_s1_{n}" for n in names1])


def arma_fit(df: DataFrame, col: str = "close", order: tuple[int, int, int] = (6, 1, 6), keys=("symbol",),
             date: str = "date", ar_long: int | None = None, block=None, wide_form: bool = False, refine: int = 0):
    """Hannan-Rissanen ARMA(p, q) on the d-times differenced series, per key.

    Coefficients in long form ``keys, term, coef`` plus ``sigma2``, ``aic``, ``n``;
    with ``wide_form`` one row per key (``const, ar_L1.., ma_L1..``), the form of a
    model that ``arma_predict`` and ``arma_forecast`` take. A moving average that is
    not invertible (possible in short series) is shrunk until it is. Each of ``refine``
    steps corrects the coefficients by a regression of the model's residuals on
    their derivatives (two scans and one Gram pass).
    """
    p, d, q = order
    keys = list(keys)
    m = _long_ar_order(p, q, ar_long)
    lagged = _lags(df, col, d, m + q, keys, date, block)
    rows = _with_residual_lags(lagged, keys, m, q)
    names = _arma_names(p, q)
    xs = [F.lit(1.0), *[F.col(f"_v{i}") for i in range(1, p + 1)], *[F.col(f"_e{j}") for j in range(1, q + 1)]]
    g2 = gm.gram(rows, keys, xs, F.col("_v0"))
    wide = _wide_coefs(g2, keys, len(names), names, "", q)
    for _ in range(refine):
        wide = _corrected(df, wide, col, order, keys, date, block)
    k = len(names)
    aic = F.col("_nfit") * (F.lit(math.log(2 * math.pi)) + F.log("_sigma2") + F.lit(1.0)) + F.lit(2.0 * (k + 1))
    wide = wide.withColumn("aic", aic)
    wide = wide.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if t == "double" and c not in keys else F.col(c) for c, t in wide.dtypes])
    stack = ", ".join(f"'{n.replace('_L', '.L')}', {n}" for n in names)
    if wide_form:
        return wide.withColumnsRenamed({"_sigma2": "sigma2", "_nfit": "n"})
    return wide.selectExpr(*keys, f"stack({k}, {stack}) AS (term, coef)", "_sigma2 AS sigma2", "aic", "_nfit AS n")


def arma_residuals(df: DataFrame, models: DataFrame, col: str = "close", order=(6, 1, 6), keys=("symbol",), date: str = "date",
                   block=None, block_rows: int = halo.DEFAULT_BLOCK_ROWS, keep: bool = False) -> DataFrame:
    """Residuals of one model per key (wide form): ``keys, date, col, residual`` with positions.

    They start at the first row whose p lags are there; before it they are taken
    as 0. ``keep`` keeps the lags, the coefficients and ``_u``, the part of the
    residual without the moving average.
    """
    p, d, q = order
    keys = list(keys)
    lagged = _lags(df, col, d, p, keys, date, block, block_rows)
    j = halo.join_null_safe(lagged, models.select(*keys, *_arma_names(p, q)), keys)
    u = F.col("_v0") - F.col("const")
    for i in range(1, p + 1):
        u = u - F.col(f"ar_L{i}") * F.col(f"_v{i}")
    j = j.withColumn("_u", u)
    if not keep:
        j = j.select(*keys, date, col, halo.IDX, halo.CNT, halo.BLK, "_v0", "_u", *[f"ma_L{i}" for i in range(1, q + 1)])
    return rec.scan(j, {"residual": "_u"}, [f"ma_L{i}" for i in range(1, q + 1)], keys)


def _corrected(df, wide, col, order, keys, date, block) -> DataFrame:
    """One Gauss-Newton step: the model's residuals regressed on their derivatives, the solution added to the coefficients.

    The derivatives obey the same recurrence: by the constant that of 1, by
    ``ar_i`` that of the series (lagged), by ``ma_j`` that of the residuals. A key
    whose system can't be solved, or whose residuals would not get smaller, keeps
    its model.
    """
    p, d, q = order
    names, ma = _arma_names(p, q), [f"ma_L{i}" for i in range(1, q + 1)]
    schema = wide.schema
    ensure_importable(df.sparkSession)
    from barflow.session import materialize

    wide = materialize(wide.drop("aic"), "arma-models")  # one row per key
    e = arma_residuals(df, wide, col, order, keys, date, block, keep=True).withColumn("_one", F.when(F.col("_u").isNotNull(), 1.0))
    e = e.withColumn("_w", F.when(F.col("_u").isNotNull(), F.col("_v0")))
    e = rec.scan(e, {"_dc": "_one", "_dv": "_w", "_de": "residual"}, ma, keys)
    e = materialize(e.select(*keys, date, halo.IDX, halo.CNT, "residual", "_dc", "_dv", "_de"), "arma-derivatives")
    h = halo.with_halo(e, max(p, q, 1))
    w = halo.block_window(keys)
    xs = {"_x0": F.col("_dc"), **{f"_x{i}": F.lag("_dv", i).over(w) for i in range(1, p + 1)}, **{f"_x{p + i}": F.lag("_de", i).over(w) for i in range(1, q + 1)}}
    k = len(xs)
    g = gm.gram(halo.core(h.withColumns(xs)), keys, [F.col(f"_x{i}") for i in range(k)], F.col("residual"))
    solved = g.select(*[F.col(c).alias(f"_k_{c}") for c in keys], "g", F.col("n").alias("_n"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys]
    joined = wide.join(solved, same, "left").drop(*[f"_k_{c}" for c in keys])

    def add(batches):
        for pdf in batches:
            rows = []
            for _, r in pdf.iterrows():
                new = {c: r[c] for c in [*keys, *names, "_sigma2", "_nfit"]}
                if r["g"] is None:  # no residual: nothing to correct
                    rows.append(new)
                    continue
                xtx, xty, yty = gm.unpack(r["g"], k)
                n, now = int(r["_n"]), np.array([r[c] for c in names], float)
                try:
                    step = np.linalg.solve(xtx, xty)
                except np.linalg.LinAlgError:
                    step = np.full(k, np.nan)
                left = yty - step @ xty
                if np.isfinite(step).all() and n > k and 0 < left <= yty:
                    after = now + step
                    after[1 + p :] = rec.shrink_to_invertible(after[1 + p :])
                    new |= dict(zip(names, after.tolist())) | {"_sigma2": left / n, "_nfit": n}
                rows.append(new)
            yield pd.DataFrame(rows, columns=[f.name for f in schema.fields if f.name != "aic"])

    return joined.mapInPandas(add, T.StructType([f for f in schema.fields if f.name != "aic"]))


def arma_order_grid(df: DataFrame, col: str = "close", p_values=range(1, 7), q_values=range(1, 7), d: int = 0,
                    keys=("symbol",), date: str = "date", ar_long: int | None = None, block=None) -> DataFrame:
    """AIC of every (p, q) in the grid, all fitted on the same rows per key.

    One Gram pass over ``[1, v_1..v_P, e_1..e_Q]``; each candidate is a
    sub-system solved in pandas. Output ``keys, p, d, q, aic, sigma2, n, best``.
    """
    keys = list(keys)
    pmax, qmax = max(p_values), max(q_values)
    m = _long_ar_order(pmax, qmax, ar_long)
    rows = _with_residual_lags(_lags(df, col, d, m + qmax, keys, date, block), keys, m, qmax)
    xs = [F.lit(1.0), *[F.col(f"_v{i}") for i in range(1, pmax + 1)], *[F.col(f"_e{j}") for j in range(1, qmax + 1)]]
    g = gm.gram(rows, keys, xs, F.col("_v0"))
    k = len(xs)
    schema = ", ".join(f"{c} {g.schema[c].dataType.simpleString()}" for c in keys)
    schema += ", p int, d int, q int, aic double, sigma2 double, n long"
    pv, qv = list(p_values), list(q_values)

    def run(batches):
        for pdf in batches:
            out = []
            for _, r in pdf.iterrows():
                xtx, xty, yty = gm.unpack(r["g"], k)
                n = int(r["n"])
                for pp in pv:
                    for qq in qv:
                        idx = [0, *range(1, pp + 1), *range(1 + pmax, 1 + pmax + qq)]
                        _, _, ssr = gm.ols_from_gram(xtx, xty, yty, n, idx)
                        s2 = ssr / n if n else float("nan")
                        out.append({**{c: r[c] for c in keys}, "p": pp, "d": d, "q": qq,
                                    "aic": gm.aic_ls(ssr, n, len(idx) + 1), "sigma2": s2, "n": n})
            yield pd.DataFrame(out, columns=[*keys, "p", "d", "q", "aic", "sigma2", "n"])

    ensure_importable(g.sparkSession)
    res = g.mapInPandas(run, schema)
    wk = Window.partitionBy(*keys).orderBy("aic", "p", "q")  # |grid| rows per key
    return res.withColumn("best", F.row_number().over(wk) == 1)


def arma_predict(df: DataFrame, col: str = "close", order=(6, 1, 6), keys=("symbol",), date: str = "date",
                 ar_long: int | None = None, start: int | None = None, end: int | None = None, block=None,
                 models: DataFrame | None = None, refine: int = 0, block_rows: int = halo.DEFAULT_BLOCK_ROWS) -> DataFrame:
    """In-sample one-step predictions (levels), ``keys, date, actual, prediction``.

    ``models`` (wide form of ``arma_fit``, or a loaded table) or a fit on ``df``.
    Innovations are the model's own residuals, so a prediction is the actual value
    less its residual. ``start``/``end`` select positions (0-based) like a
    ``predict(start, end)`` call; default: every row that has a prediction.
    """
    if models is None:
        models = arma_fit(df, col, order, keys, date, ar_long, block, wide_form=True, refine=refine)
    j = arma_residuals(df, models, col, order, keys, date, block, block_rows)
    out = j.select(*keys, date, F.col(col).alias("actual"), (F.col(col) - F.col("residual")).alias("prediction"), F.col(halo.IDX).alias("_pos"))
    out = out.where(F.col("prediction").isNotNull() & ~F.isnan("prediction"))
    if start is not None:
        out = out.where(F.col("_pos") >= start)
    if end is not None:
        out = out.where(F.col("_pos") <= end)
    return out.drop("_pos")


def arma_forecast(df: DataFrame, col: str = "close", order=(6, 1, 6), horizon: int = 30, keys=("symbol",),
                  date: str = "date", ar_long: int | None = None, skip_weekends: bool = False,
                  block=None, round_digits: int | None = None, models: DataFrame | None = None, refine: int = 0) -> DataFrame:
    """h-step forecasts per key: ``keys, step, date, forecast`` (levels).

    ``round_digits`` adds ``forecast_rounded`` (half-even, like Python's ``round``).

    ``models`` as in ``arma_predict``. Only the last ``max(p, q)`` rows of each
    key (a bounded set) leave the frame of residuals; the recursion runs per key
    in pandas.
    """
    p, d, q = order
    keys = list(keys)
    wide = arma_fit(df, col, order, keys, date, ar_long, block, wide_form=True, refine=refine) if models is None else models
    rows = arma_residuals(df, wide, col, order, keys, date, block).withColumnRenamed("residual", "_e0")
    r = max(p, q, 2)  # two rows at least: their distance is the step of a timestamp series
    tail = rows.where(F.col(halo.IDX) >= F.col(halo.CNT) - r)
    packed = tail.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(F.col(halo.IDX).alias("i"), F.col("_v0").alias("v"),
                                             F.col("_e0").alias("e"), F.col(col).alias("y"),
                                             F.col(date).alias("dt")))).alias("_tail")
    )
    names = _arma_names(p, q)
    j = halo.join_null_safe(packed, wide.select(*keys, *names), keys)
    schema = ", ".join(f"{c} {j.schema[c].dataType.simpleString()}" for c in keys)
    hourly = str(df.schema[date].dataType.simpleString()).startswith("timestamp")
    schema += f", step int, {date} {df.schema[date].dataType.simpleString()}, forecast double"

    def run(batches):
        for pdf in batches:
            out = []
            for _, rr in pdf.iterrows():
                t = list(rr["_tail"])
                vs = [x["v"] for x in t]
                es = [x["e"] if x["e"] is not None else 0.0 for x in t]
                level = t[-1]["y"]
                last = t[-1]["dt"]
                c = rr["const"]
                ar = [rr[f"ar_L{i}"] for i in range(1, p + 1)]
                ma = [rr[f"ma_L{i}"] for i in range(1, q + 1)]
                hist_v = [x if x is not None else 0.0 for x in vs]
                hist_e = es[:]
                day = pd.Timestamp(last)
                gap = day - pd.Timestamp(t[-2]["dt"]) if hourly and len(t) > 1 else pd.Timedelta(days=1)
                for h in range(1, horizon + 1):
                    nv = c + sum(a * hist_v[-i] for i, a in enumerate(ar, 1) if i <= len(hist_v))
                    nv += sum(b * hist_e[-i] for i, b in enumerate(ma, 1) if i <= len(hist_e))
                    hist_v.append(nv)
                    hist_e.append(0.0)
                    level = level + nv if d == 1 else nv
                    day = day + gap
                    while skip_weekends and day.dayofweek >= 5:
                        day = day + pd.Timedelta(days=1)
                    out.append({**{k: rr[k] for k in keys}, "step": h, date: day if hourly else day.date(), "forecast": float(level)})
            yield pd.DataFrame(out, columns=[*keys, "step", date, "forecast"])

    ensure_importable(j.sparkSession)
    out = j.mapInPandas(run, schema)
    if round_digits is not None:
        out = out.withColumn("forecast_rounded", F.bround("forecast", round_digits))
    return out
