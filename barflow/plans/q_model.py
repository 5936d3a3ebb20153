"""Queries: target/split, set-difference parity, sequences, scaling, metrics, joins, blend, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.functions.dates import future_dates
from barflow.operators import indicators as ind, metrics as mt, scale as sc, sequences as sq, split as sp
from barflow.plans.q_features import ADJ, LIN, ORD, features_sql, lin, ord_adj
from barflow.plans.registry import part, r4, register, rounded
from barflow.session import materialize, scratch_path
from barflow.sources import bars as src

SCALE_COLS = ["open", "high", "low", "close", "volume"]
LOOK_BACK = 5

# model table (features + next close) with a per-symbol chronological split
SPLIT_CTE = f"""{features_sql(True)},
pos AS (SELECT *, row_number() OVER ({part()}) - 1 AS idx, count(*) OVER (PARTITION BY symbol) AS n FROM feat),
sp AS (SELECT *, CASE WHEN idx < floor(0.8 * n) THEN 'train' ELSE 'test' END AS split FROM pos)"""


def model_table(spark, sf, bars=None):
    """Features + target for F-ORD, chronologically split per symbol.

    Both the feature table and the split model table are written once (shared
    checkpoint folder): the split's count pass, and every consumer of the model
    table (stats, predictions, joins, ML passes), then read files instead of
    re-running the windowed feature build.
    """
    feats = materialize(ind.technical_features(ord_adj(spark, sf) if bars is None else bars, with_target=True), "features")
    return materialize(sp.chrono_split(feats), "model-table")


@register("chrono_split", sql=f"WITH {SPLIT_CTE} SELECT symbol, date, split FROM sp", ops="U3 U4")
def q_chrono_split(spark, sf):
    return model_table(spark, sf).select("symbol", "date", "split")


@register(
    "split_except_all",
    sql=f"""WITH {SPLIT_CTE}
SELECT symbol, date, {r4("close", "close")}, {r4("target", "target")} FROM (
  SELECT symbol, date, close, target FROM feat EXCEPT ALL
  SELECT symbol, date, close, target FROM sp WHERE split = 'train')""",
    ops="U2 (reference-parity test set)",
)
def q_split_except_all(spark, sf):
    m = model_table(spark, sf)
    cols = ["symbol", "date", "close", "target"]
    return rounded(sp.except_all_split(m.select(*cols), m.where(F.col("split") == "train").select(*cols)))


@register(
    "split_subtract",
    sql=f"""WITH {SPLIT_CTE}
SELECT symbol, {r4("close", "close")} FROM (
  SELECT symbol, close FROM feat EXCEPT SELECT symbol, close FROM sp WHERE split = 'train')""",
    ops="U1 (EXCEPT DISTINCT)",
)
def q_split_subtract(spark, sf):
    m = model_table(spark, sf)
    return rounded(sp.subtract_split(m.select("symbol", "close"), m.where(F.col("split") == "train").select("symbol", "close")))


@register(
    "time_folds",
    sql=f"""WITH {SPLIT_CTE},
tr AS (SELECT symbol, date, row_number() OVER ({part()}) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS m
       FROM sp WHERE split = 'train')
SELECT symbol, date, CAST(floor(i * 3 / m) AS INTEGER) AS fold FROM tr""",
    ops="M7 time-blocked folds",
)
def q_time_folds(spark, sf):
    train = model_table(spark, sf).where(F.col("split") == "train")
    return sp.time_folds(train, 3).select("symbol", "date", "fold")


@register(
    "first_difference",
    sql=f"WITH {ORD}, {ADJ}, d AS (SELECT symbol, date, close - lag(close) OVER ({part()}) AS diff_1 FROM b) "
    f"SELECT symbol, date, {r4('diff_1', 'diff_1')} FROM d WHERE diff_1 IS NOT NULL",
    ops="W10",
)
def q_first_difference(spark, sf):
    d = sq.difference(ord_adj(spark, sf), "close", 1)
    return rounded(d.select("symbol", "date", "diff_1"))


@register(
    "second_difference",
    sql=f"WITH {ORD}, {ADJ}, d AS (SELECT symbol, date, close - 2 * lag(close, 1) OVER ({part()}) "
    f"+ lag(close, 2) OVER ({part()}) AS diff_2 FROM b) "
    f"SELECT symbol, date, {r4('diff_2', 'diff_2')} FROM d WHERE diff_2 IS NOT NULL",
    ops="W10 (order d)",
)
def q_second_difference(spark, sf):
    d = sq.difference(ord_adj(spark, sf), "close", 2)
    return rounded(d.select("symbol", "date", "diff_2"))


def _lookback_sql(drop_last: bool, kind: str = "DOUBLE") -> str:
    xs = ", ".join(r4(f"lag(CAST(close AS {kind}), {LOOK_BACK - i}) OVER ({part()})", f"x_{i + 1}") for i in range(LOOK_BACK))
    last = f", lead(date) OVER ({part()}) AS nxt" if drop_last else ""
    cond = " AND nxt IS NOT NULL" if drop_last else ""
    return f"""WITH {LIN},
l AS (SELECT symbol, date, {xs}, {r4(f"CAST(close AS {kind})", "y")}, row_number() OVER ({part()}) AS rn{last} FROM b)
SELECT symbol, date, {", ".join(f"x_{i + 1}" for i in range(LOOK_BACK))}, y FROM l WHERE rn > {LOOK_BACK}{cond}"""


@register("lookback_sequences", sql=_lookback_sql(False), ops="W11 J4")
def q_lookback_sequences(spark, sf):
    s = sq.lookback_sequences(lin(spark, sf), "close", LOOK_BACK)
    return rounded(sq.sequences_to_columns(s, LOOK_BACK))


@register("lookback_drop_last", sql=_lookback_sql(True), ops="W12")
def q_lookback_drop_last(spark, sf):
    s = sq.lookback_sequences(lin(spark, sf), "close", LOOK_BACK, drop_last=True)
    return rounded(sq.sequences_to_columns(s, LOOK_BACK))


def _minmax_sql(inverse: bool) -> str:
    stats = ", ".join(
        f"min(CAST({c} AS DOUBLE)) AS {c}_min, max(CAST({c} AS DOUBLE)) AS {c}_max" for c in SCALE_COLS
    )
    scaled = [
        f"CASE WHEN {c}_max = {c}_min THEN 0.5 ELSE (CAST({c} AS DOUBLE) - {c}_min) / ({c}_max - {c}_min) END AS {c}_scaled"
        for c in SCALE_COLS
    ]
    body = f"""WITH {SPLIT_CTE},
m AS (SELECT symbol, {stats} FROM sp WHERE split = 'train' GROUP BY symbol),
s AS (SELECT sp.symbol, date, split, {", ".join(scaled)}, {", ".join(f"{c}_min, {c}_max" for c in SCALE_COLS)}
      FROM sp JOIN m USING (symbol))"""
    if inverse:
        return body + f" SELECT symbol, date, {r4('close_min + close_scaled * (close_max - close_min)', 'close_restored')} FROM s"
    return body + " SELECT symbol, date, split, " + ", ".join(r4(f"{c}_scaled", f"{c}_scaled") for c in SCALE_COLS) + " FROM s"


def _scaled(spark, sf):
    m = model_table(spark, sf)
    stats = sc.fit_minmax(m, SCALE_COLS, where=F.col("split") == "train")
    return sc.apply_minmax(m, stats, SCALE_COLS), stats


@register("minmax_scale", sql=_minmax_sql(False), ops="M2")
def q_minmax_scale(spark, sf):
    s, _ = _scaled(spark, sf)
    return rounded(s.select("symbol", "date", "split", *[f"{c}_scaled" for c in SCALE_COLS]))


@register("inverse_minmax", sql=_minmax_sql(True), ops="M3")
def q_inverse_minmax(spark, sf):
    s, stats = _scaled(spark, sf)
    back = sc.inverse_minmax(s.select("symbol", "date", "close_scaled"), stats.select("symbol", "close_min", "close_max"),
                             ["close"])
    return rounded(back.select("symbol", "date", "close_restored"))


@register("scale_and_save", sql=_minmax_sql(False), ops="S11 (train, test and scaler written and read again)")
def q_scale_and_save(spark, sf):
    m = model_table(spark, sf)
    path = scratch_path(spark, "scaled-pair")
    sc.scale_and_save(spark, m.where(F.col("split") == "train"), m.where(F.col("split") == "test"), SCALE_COLS, path)
    both = spark.read.parquet(f"{path}/train").unionByName(spark.read.parquet(f"{path}/test"))
    return rounded(both.select("symbol", "date", "split", *[f"{c}_scaled" for c in SCALE_COLS]))


@register("lookback_float", sql=_lookback_sql(False, "FLOAT"), ops="F10 (single-precision sequences)")
def q_lookback_float(spark, sf):
    s = sq.lookback_sequences(lin(spark, sf), "close", LOOK_BACK, dtype="float")
    s = sq.sequences_to_columns(s, LOOK_BACK)
    return rounded(s.select(*[F.col(c).cast("double").alias(c) if kind == "float" else F.col(c) for c, kind in s.dtypes]))


_NAIVE_CTE = f"""{SPLIT_CTE},
p AS (SELECT symbol, date, split, target AS label, close AS prediction FROM sp)"""


@register(
    "regression_metrics",
    sql=f"""WITH {_NAIVE_CTE}
SELECT symbol, split, count(*) AS n, round(avg((label - prediction) * (label - prediction)), 2) AS mse,
       {r4("avg(abs(label - prediction))", "mae")}, {r4("sqrt(avg((label - prediction) * (label - prediction)))", "rmse")},
       {r4("1 - sum((label - prediction) * (label - prediction)) / nullif(var_pop(label) * count(*), 0)", "r2")}
FROM p GROUP BY symbol, split""",
    ops="A12 (naive last-close predictor)",
)
def q_regression_metrics(spark, sf):
    m = model_table(spark, sf).select("symbol", "date", "split", F.col("target").alias("label"),
                                      F.col("close").alias("prediction"))
    m = mt.regression_metrics(m, group=["symbol", "split"])
    return rounded(m.withColumn("mse", F.round("mse", 2)))  # 1e10 and more: a double has no fourth decimal there


_OLS_CTE = f"""{SPLIT_CTE},
o AS (SELECT symbol, regr_slope(target, close) AS slope, regr_intercept(target, close) AS intercept,
        regr_r2(target, close) AS r2, CAST(regr_count(target, close) AS BIGINT) AS n FROM sp WHERE split = 'train' GROUP BY symbol)"""


@register(
    "ols_simple",
    sql=f"WITH {_OLS_CTE} SELECT symbol, {r4('slope', 'slope')}, {r4('intercept', 'intercept')}, {r4('r2', 'r2')}, n FROM o",
    ops="M5 (one regressor, SQL aggregates)",
)
def q_ols_simple(spark, sf):
    m = model_table(spark, sf).where(F.col("split") == "train")
    return rounded(mt.ols_simple(m, "target", "close"))


@register(
    "prediction_join",
    sql=f"""WITH {_OLS_CTE},
t AS (SELECT symbol, date, close, target FROM sp WHERE split = 'test'),
pr AS (SELECT t.symbol, t.date, o.intercept + o.slope * t.close AS prediction FROM t JOIN o USING (symbol))
SELECT t.symbol, t.date, {r4("t.target", "label")}, {r4("pr.prediction", "prediction")}
FROM t LEFT JOIN pr ON t.symbol = pr.symbol AND t.date = pr.date""",
    ops="J1 J3 D1",
)
def q_prediction_join(spark, sf):
    m = model_table(spark, sf)
    coef = mt.ols_simple(m.where(F.col("split") == "train"), "target", "close")
    test = m.where(F.col("split") == "test").select("symbol", "date", "close", F.col("target").alias("label"))
    pred = test.join(coef, "symbol").select(
        "symbol", "date", (F.col("intercept") + F.col("slope") * F.col("close")).alias("prediction")
    )
    return rounded(test.join(pred, ["symbol", "date"], "left").select("symbol", "date", "label", "prediction"))


@register(
    "blend_predictions",
    sql=f"""WITH {SPLIT_CTE},
a AS (SELECT symbol, date, target AS label, close AS pred_a FROM sp WHERE split = 'test'),
c AS (SELECT symbol, date, ma_10 AS pred_b FROM sp WHERE split = 'test')
SELECT a.symbol, a.date, {r4("label", "label")}, {r4("pred_a", "pred_a")}, {r4("pred_b", "pred_b")},
       {r4("0.7 * pred_a + 0.3 * pred_b", "blend")} FROM a JOIN c ON a.symbol = c.symbol AND a.date = c.date""",
    ops="J2 M14",
)
def q_blend_predictions(spark, sf):
    from barflow.operators.ensemble import blend

    test = model_table(spark, sf).where(F.col("split") == "test")
    a = test.select("symbol", "date", F.col("target").alias("label"), F.col("close").alias("pred_a"))
    b = test.select("symbol", "date", F.col("ma_10").alias("pred_b"))
    return rounded(blend(a, b, "pred_a", "pred_b", 0.7, 0.3))


@register(
    "future_dates",
    sql=f"""WITH {ORD}, l AS (SELECT symbol, max(date) AS last_date FROM bars GROUP BY symbol),
s AS (SELECT symbol, last_date, unnest(generate_series(1, 30)) AS step FROM l)
SELECT symbol, CAST(step AS INTEGER) AS step, CAST(last_date + CAST(step AS INTEGER) AS DATE) AS date FROM s""",
    ops="F12",
)
def q_future_dates(spark, sf):
    return future_dates(src.ord_bars(spark, sf), 30)


@register(
    "inverse_scale_global",
    sql=f"""WITH {LIN}, mm AS (SELECT min(close) AS mn, max(close) AS mx FROM b),
s AS (SELECT symbol, date, close, (close - mn) / (mx - mn) AS scaled, mn, mx FROM b, mm)
SELECT symbol, date, {r4("scaled", "scaled")}, {r4("mn + scaled * (mx - mn)", "close_restored")} FROM s""",
    ops="A8 M3 (global min/max in one aggregate, inverse scaling)",
)
def q_inverse_scale_global(spark, sf):
    b = lin(spark, sf)
    mn, mx = b.agg(F.min("close"), F.max("close")).first()  # two scalars from one aggregate job
    scaled = b.select("symbol", "date", ((F.col("close") - F.lit(mn)) / F.lit(mx - mn)).alias("scaled"))
    return rounded(mt.inverse_scale_close(scaled, b, "close", "scaled").select("symbol", "date", "scaled",
                                                                                 "close_restored"))
