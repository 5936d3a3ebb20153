"""Queries: autocorrelation, partial autocorrelation, ADF, ARMA fit/grid/prediction/forecast."""

from __future__ import annotations

from barflow.operators import dickey_fuller, models, tsa
from barflow.plans.q_features import ADJ, LIN, ORD, lin, ord_adj
from barflow.plans.registry import QUERIES, part, r4, register, rounded
from barflow.session import scratch_path

NLAGS = 40


def _acf_cte() -> str:
    """CTEs up to ``a(symbol, n, lag, acf)``."""
    prods = ", ".join(f"z * lag(z, {k}) OVER ({part()}) AS p{k}" for k in range(1, NLAGS + 1))
    sums = ", ".join(f"sum(p{k}) AS s{k}" for k in range(1, NLAGS + 1))
    rows = " UNION ALL ".join(
        f"SELECT symbol, n, {k} AS lag, {'1.0' if k == 0 else f's{k} / s0'} AS acf FROM s" for k in range(NLAGS + 1)
    )
    return f"""{LIN},
dd AS (SELECT symbol, date, close - lag(close) OVER ({part()}) AS v FROM b),
d AS (SELECT * FROM dd WHERE v IS NOT NULL),
m AS (SELECT symbol, avg(v) AS m, count(*) AS n FROM d GROUP BY symbol),
z AS (SELECT d.symbol, d.date, d.v - m.m AS z, m.n FROM d JOIN m USING (symbol)),
l AS (SELECT symbol, date, n, z * z AS p0, {prods} FROM z),
s AS (SELECT symbol, max(n) AS n, sum(p0) AS s0, {sums} FROM l GROUP BY symbol),
a AS ({rows})"""


def _acf_sql() -> str:
    return f"""WITH {_acf_cte()},
c AS (SELECT *, coalesce(sum(CASE WHEN lag >= 1 THEN acf * acf END) OVER (PARTITION BY symbol ORDER BY lag
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS prev_sq FROM a)
SELECT symbol, CAST(lag AS INTEGER) AS lag, {r4("acf", "acf")},
       {r4("CASE WHEN lag = 0 THEN 0.0 ELSE 1.96 * sqrt((1 + 2 * prev_sq) / n) END", "conf_band")}, n FROM c"""


def _acf_df(spark, sf):
    return tsa.acf(lin(spark, sf), "close", NLAGS, d=1)


@register("acf_40", sql=_acf_sql(), ops="A13 (differenced series, Bartlett band)")
def q_acf_40(spark, sf):
    return rounded(_acf_df(spark, sf))


def _pacf_sql() -> str:
    """Durbin-Levinson as a recursive CTE: ``phi`` holds the coefficients of order ``k``, ``p`` the last of them."""
    within = "range(1, k + 1)"
    return f"""WITH RECURSIVE {_acf_cte()},
r AS (SELECT symbol, n, list(acf ORDER BY lag) FILTER (WHERE lag > 0) AS r FROM a GROUP BY symbol, n),
dl AS (SELECT symbol, n, r, 1 AS k, r[1] AS p, [r[1]] AS phi FROM r
  UNION ALL SELECT symbol, n, r, k + 1, pk, list_append(list_transform({within}, lambda j: phi[j] - pk * phi[k + 1 - j]), pk)
  FROM (SELECT *, (r[k + 1] - list_sum(list_transform({within}, lambda j: phi[j] * r[k + 1 - j])))
          / nullif(1 - list_sum(list_transform({within}, lambda j: phi[j] * r[j])), 0) AS pk FROM dl WHERE k < {NLAGS}))
SELECT symbol, CAST(k AS INTEGER) AS lag, {r4("p", "pacf")}, {r4("1.96 / sqrt(n)", "conf_band")}, n FROM dl
UNION ALL SELECT symbol, 0, 1.0, 0.0, n FROM r"""


@register("pacf_40", sql=_pacf_sql(), ops="A14 (Durbin-Levinson on A13)")
def q_pacf_40(spark, sf):
    return rounded(tsa.pacf(_acf_df(spark, sf)))


def _crit_sql(level: str) -> str:
    c0, c1, c2, c3 = tsa.ADF_CRIT_CONST[level]
    t = "CAST(n AS DOUBLE)"
    return f"({c0} + ({c1}) / {t} + ({c2}) / ({t} * {t}) + ({c3}) / ({t} * {t} * {t}))"


_ADF0_CTE = f"""{ORD}, {ADJ},
d AS (SELECT symbol, close - lag(close) OVER ({part()}) AS dy, lag(close) OVER ({part()}) AS ylag FROM b),
r AS (SELECT symbol, regr_slope(dy, ylag) AS beta, regr_sxx(dy, ylag) AS sxx, regr_syy(dy, ylag) AS syy,
        regr_sxy(dy, ylag) AS sxy, CAST(regr_count(dy, ylag) AS BIGINT) AS n FROM d GROUP BY symbol),
t AS (SELECT *, beta / sqrt(((syy - sxy * sxy / sxx) / (n - 2)) / sxx) AS adf_stat FROM r)"""


def _p_value_sql(stat: str, n: str, source: str) -> str:
    """CTEs up to ``pv(symbol, p_value)``: the fixed surface as a table, its quantiles for each symbol's T, the piece that holds the statistic."""
    values = ", ".join(f"({p}, {', '.join(f'CAST({c} AS DOUBLE)' for c in coef)})" for p, coef in dickey_fuller.SURFACE.items())
    t = f"greatest(CAST({n} AS DOUBLE), {dickey_fuller.LEAST})"
    return f"""surface(p, c0, c1, c2, c3) AS (VALUES {values}),
q AS (SELECT symbol, {stat} AS s, ln(p / (1 - p)) AS z, c0 + c1 / {t} + c2 / pow({t}, 2) + c3 / pow({t}, 3) AS q FROM {source} CROSS JOIN surface),
piece AS (SELECT *, lead(q) OVER w AS q1, lead(z) OVER w AS z1, row_number() OVER w AS k FROM q WINDOW w AS (PARTITION BY symbol ORDER BY z)),
pv AS (SELECT symbol, 1 / (1 + exp(-(z + (z1 - z) * (s - q) / (q1 - q)))) AS p_value FROM piece WHERE z1 IS NOT NULL AND (s >= q OR k = 1)
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY k DESC) = 1)"""


@register(
    "adf_lag0",
    sql=f"""WITH {_ADF0_CTE}, {_p_value_sql("adf_stat", "n", "t")}
SELECT symbol, n, {r4("adf_stat", "adf_stat")}, {r4(_crit_sql("1%"), "crit_1")}, {r4(_crit_sql("5%"), "crit_5")},
       {r4(_crit_sql("10%"), "crit_10")}, adf_stat < {_crit_sql("5%")} AS stationary_5, {r4("p_value", "p_value")} FROM t JOIN pv USING (symbol)""",
    ops="A15 (no augmentation lags; p-value from the simulated surface)",
)
def q_adf_lag0(spark, sf):
    return rounded(tsa.adf_lag0(ord_adj(spark, sf)))


@register("adf_auto", ops="A15 (AIC lag choice, Schwert max lag)")
def q_adf_auto(spark, sf):
    return rounded(tsa.adf(ord_adj(spark, sf)))


@register("adf_auto_diff", ops="A15 on the first difference (W10 -> A15)")
def q_adf_auto_diff(spark, sf):
    from barflow.operators.sequences import difference

    d = difference(ord_adj(spark, sf), "close", 1, out="close_diff")
    return rounded(tsa.adf(d, "close_diff"))


@register("arma_fit", ops="M9 (Hannan-Rissanen, order 6,1,6)")
def q_arma_fit(spark, sf):
    return rounded(tsa.arma_fit(ord_adj(spark, sf), "close", (6, 1, 6)))


_AR1 = f"""WITH {ORD}, {ADJ},
v AS (SELECT symbol, date, close - lag(close) OVER ({part()}) AS v FROM b),
l AS (SELECT symbol, v, lag(v) OVER ({part()}) AS v1 FROM v),
r AS (SELECT symbol, regr_slope(v, v1) AS slope, regr_intercept(v, v1) AS icept, CAST(regr_count(v, v1) AS BIGINT) AS n FROM l GROUP BY symbol)"""


@register(
    "arma_110_fit",
    sql=f"""{_AR1}
SELECT symbol, 'const' AS term, {r4("icept", "coef")}, n FROM r
UNION ALL SELECT symbol, 'ar.L1', {r4("slope", "coef")}, n FROM r""",
    ops="M9 (order 1,1,0: closed form)",
)
def q_arma_110_fit(spark, sf):
    return rounded(tsa.arma_fit(ord_adj(spark, sf), "close", (1, 1, 0)).select("symbol", "term", "coef", "n"))


@register(
    "arma_110_insample",
    sql=f"""{_AR1},
p AS (SELECT symbol, date, close, lag(close) OVER ({part()}) AS y1, lag(close, 2) OVER ({part()}) AS y2,
        row_number() OVER ({part()}) - 1 AS pos FROM b)
SELECT symbol, date, {r4("close", "actual")}, {r4("y1 + icept + slope * (y1 - y2)", "prediction")}
FROM p JOIN r USING (symbol) WHERE y2 IS NOT NULL AND pos BETWEEN 10 AND 999""",
    ops="M10 (order 1,1,0, positions 10 to 999)",
)
def q_arma_110_insample(spark, sf):
    return rounded(tsa.arma_predict(ord_adj(spark, sf), "close", (1, 1, 0), start=10, end=999))


@register(
    "arma_110_forecast",
    sql=f"""WITH RECURSIVE {_AR1.removeprefix("WITH ")},
t AS (SELECT symbol, date, close, close - lag(close) OVER ({part()}) AS v, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS k FROM b),
fc AS (SELECT t.symbol, 0 AS step, t.date, t.close AS y, t.v, r.slope, r.icept FROM t JOIN r USING (symbol) WHERE k = 1
       UNION ALL SELECT symbol, step + 1, CAST(date + 1 AS DATE), y + icept + slope * v, icept + slope * v, slope, icept FROM fc WHERE step < 30)
SELECT symbol, CAST(step AS INTEGER) AS step, date, {r4("y", "forecast")} FROM fc WHERE step > 0""",
    ops="M11 F12 (order 1,1,0)",
)
def q_arma_110_forecast(spark, sf):
    return rounded(tsa.arma_forecast(ord_adj(spark, sf), "close", (1, 1, 0), 30))


_AR1MA1 = f"""WITH RECURSIVE {_AR1.removeprefix("WITH ")},
s1 AS (SELECT l.symbol, b.date, l.v, l.v1, l.v - r.icept - r.slope * l.v1 AS e FROM (SELECT symbol, date, v, lag(v) OVER ({part()}) AS v1 FROM v) l
  JOIN r USING (symbol) JOIN b USING (symbol, date)),
s2 AS (SELECT symbol, date, v, v1, lag(e) OVER ({part()}) AS w FROM s1),
n AS (SELECT symbol, avg(v) AS mv, avg(v1) AS mx, avg(w) AS mw, regr_sxx(v, v1) AS sxx, regr_sxx(v, w) AS sww, regr_sxy(v1, w) AS sxw,
  regr_sxy(v, v1) AS sxv, regr_sxy(v, w) AS swv, CAST(count(*) AS BIGINT) AS n FROM s2 WHERE w IS NOT NULL GROUP BY symbol),
k AS (SELECT *, (sxv * sww - swv * sxw) / (sxx * sww - sxw * sxw) AS ar, (swv * sxx - sxv * sxw) / (sxx * sww - sxw * sxw) AS ma FROM n),
m AS (SELECT symbol, n, ar, greatest(-0.98, least(0.98, ma)) AS ma, mv - ar * mx - ma * mw AS c FROM k)"""  # an invertible moving average
# residuals of the fitted model, one position after another
_AR1MA1_E = f"""{_AR1MA1},
p AS MATERIALIZED (SELECT symbol, date, close, v, lag(v) OVER ({part()}) AS v1, row_number() OVER ({part()}) - 1 AS pos FROM (
  SELECT symbol, date, close, close - lag(close) OVER ({part()}) AS v FROM b)),
e AS (SELECT p.symbol, p.date, p.close, p.v, p.pos, p.v - m.c - m.ar * p.v1 AS e FROM p JOIN m USING (symbol) WHERE pos = 2
  UNION ALL SELECT p.symbol, p.date, p.close, p.v, p.pos, p.v - m.c - m.ar * p.v1 - m.ma * e.e FROM e JOIN p ON p.symbol = e.symbol AND p.pos = e.pos + 1 JOIN m ON m.symbol = e.symbol)"""


@register(
    "arma_111_fit",
    sql=f"""{_AR1MA1}
SELECT symbol, 'const' AS term, {r4("c", "coef")}, n FROM m UNION ALL SELECT symbol, 'ar.L1', {r4("ar", "coef")}, n FROM m
UNION ALL SELECT symbol, 'ma.L1', {r4("ma", "coef")}, n FROM m""",
    ops="M9 (order 1,1,1: normal equations)",
)
def q_arma_111_fit(spark, sf):
    return rounded(tsa.arma_fit(ord_adj(spark, sf), "close", (1, 1, 1), ar_long=1).select("symbol", "term", "coef", "n"))


@register("arma_111_insample", sql=f"""{_AR1MA1_E}
SELECT symbol, date, {r4("close", "actual")}, {r4("close - e", "prediction")} FROM e""", ops="M10 (order 1,1,1: the model's own innovations)")
def q_arma_111_insample(spark, sf):
    return rounded(tsa.arma_predict(ord_adj(spark, sf), "close", (1, 1, 1), ar_long=1, block_rows=256))


@register(
    "arma_111_forecast",
    sql=f"""{_AR1MA1_E},
last AS (SELECT symbol, date, close, v, e FROM e QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) = 1),
fc AS (SELECT l.symbol, 0 AS step, l.date, l.close AS y, l.v, l.e, m.c, m.ar, m.ma FROM last l JOIN m USING (symbol)
  UNION ALL SELECT symbol, step + 1, CAST(date + 1 AS DATE), y + c + ar * v + ma * e, c + ar * v + ma * e, 0.0, c, ar, ma FROM fc WHERE step < 30)
SELECT symbol, CAST(step AS INTEGER) AS step, date, {r4("y", "forecast")} FROM fc WHERE step > 0""",
    ops="M11 F12 (order 1,1,1)",
)
def q_arma_111_forecast(spark, sf):
    return rounded(tsa.arma_forecast(ord_adj(spark, sf), "close", (1, 1, 1), 30, ar_long=1))


@register("arma_saved_forecast", sql=QUERIES["arma_110_forecast"].sql, ops="S8 M13 M11 (models saved by version, loaded, forecast)")
def q_arma_saved_forecast(spark, sf):
    bars, path = ord_adj(spark, sf), scratch_path(spark, "arma-models")
    models.save_models(tsa.arma_fit(bars, "close", (1, 1, 0), wide_form=True), path)
    return rounded(tsa.arma_forecast(bars, "close", (1, 1, 0), 30, models=models.load_models(spark, path)))


@register("arma_order_grid", ops="A16 (p, q in 1..6, d = 0, AIC)")
def q_arma_order_grid(spark, sf):
    return rounded(tsa.arma_order_grid(ord_adj(spark, sf), "close"))


@register("arma_insample", ops="M10")
def q_arma_insample(spark, sf):
    return rounded(tsa.arma_predict(ord_adj(spark, sf), "close", (6, 1, 6)))


@register("arma_forecast_30", ops="M11 F12 F9")
def q_arma_forecast_30(spark, sf):
    return rounded(tsa.arma_forecast(ord_adj(spark, sf), "close", (6, 1, 6), 30, round_digits=0))
