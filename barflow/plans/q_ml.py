"""Queries: Spark ML regression, cross-validation, grid search, sequence model,
model persistence, stacking and model comparison (rows-only checks)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from barflow.operators import ensemble as en, metrics as mt, regress as rg, sequences as sq, split as sp
from barflow.plans.q_model import SPLIT_CTE, model_table
from barflow.plans.registry import part, r4, register, rounded
from barflow.plans.q_features import ord_adj
from barflow.session import materialize, scratch_path
from barflow.sources.schema import FEATURE_COLS

SEQ_LOOK_BACK = 5


def ml_table(spark, sf):
    """Model table materialised once in the shared checkpoint folder.

    Spark ML makes many passes (scaler fit, solver iterations, one fit per grid
    map and fold, evaluations); without the cut each pass would rerun the
    windowed feature build. The table is written once under
    ``spark.checkpoint.dir`` (shared storage) and survives executor loss.
    """
    return model_table(spark, sf)


def _train_test(spark, sf):
    m = ml_table(spark, sf)
    return m.where(F.col("split") == "train"), m.where(F.col("split") == "test")


@register("lr_predict", ops="M1 M2 M4 M5 (fixed params) + predictions table")
def q_lr_predict(spark, sf):
    train, test = _train_test(spark, sf)
    pipe, _ = rg.lr_pipeline(FEATURE_COLS, "target", regParam=0.01, elasticNetParam=0.0)
    model = pipe.fit(train)
    return rounded(rg.predictions(model, test, "target", "lr", "test"))


def _cv(spark, sf):
    train, test = _train_test(spark, sf)
    folds = sp.time_folds(train, 3).drop("_idx", "_n", "_blk")
    cv_model, grid, lr = rg.cross_validate(folds, FEATURE_COLS, "target", fold_col="fold")
    return cv_model, grid, lr, train, test


@register("lr_cv_best", ops="M6 M7 (27 maps x 3 time-blocked folds) + A12 on test")
def q_lr_cv_best(spark, sf):
    cv_model, grid, lr, _, test = _cv(spark, sf)
    best = rg.best_params(cv_model, grid, lr)
    pred = rg.predictions(cv_model, test, "target", "lr_cv", "test")
    m = mt.regression_metrics(pred, group=["model", "split"])
    return rounded(m.withColumns({k: F.lit(v) for k, v in best.items()}))


@register("grid_search_fit", ops="M8 (fit all maps, pick on a validation block, train/test metrics)")
def q_grid_search_fit(spark, sf):
    train, test = _train_test(spark, sf)
    inner = sp.chrono_split(train.drop("split", "_idx", "_n", "_blk"), 0.8, col="inner")
    fit_rows = inner.where(F.col("inner") == "train").drop("inner", "_idx", "_n", "_blk")
    valid = inner.where(F.col("inner") == "test").drop("inner", "_idx", "_n", "_blk")
    model, params = rg.grid_search(fit_rows, valid, FEATURE_COLS, "target")
    preds = rg.predictions(model, fit_rows, "target", "lr_grid", "train").unionByName(
        rg.predictions(model, test, "target", "lr_grid", "test")
    )
    m = mt.regression_metrics(preds, group=["model", "split"])
    return rounded(m.withColumns({k: F.lit(float(v)) for k, v in params.items()}))


_GRID = [0.1, 1000.0, 20000.0]


@register(
    "ridge_grid_search",
    sql=f"""WITH {SPLIT_CTE},
tr AS (SELECT *, row_number() OVER ({part()}) - 1 AS i, count(*) OVER (PARTITION BY symbol) AS m FROM sp WHERE split = 'train'),
inn AS (SELECT close, target, i < floor(0.8 * m) AS fitted FROM tr),
g AS (SELECT avg(close) AS mx, avg(target) AS my, covar_pop(close, target) / var_pop(close) AS slope, stddev_pop(target) AS sy FROM inn WHERE fitted),
fits AS (SELECT CAST(reg_param AS DOUBLE) AS reg_param, mx, my, slope / (1 + reg_param / sy) AS beta FROM g, (SELECT unnest({_GRID}) AS reg_param)),
v AS (SELECT reg_param, any_value(mx) AS mx, any_value(my) AS my, any_value(beta) AS beta, sqrt(avg((target - my - beta * (close - mx)) ** 2)) AS valid_metric
      FROM fits, inn WHERE NOT fitted GROUP BY reg_param ORDER BY valid_metric LIMIT 1),
p AS (SELECT 'train' AS split, target, target - my - beta * (close - mx) AS e, reg_param, valid_metric FROM inn, v WHERE fitted
      UNION ALL SELECT 'test', target, target - my - beta * (close - mx), reg_param, valid_metric FROM sp, v WHERE split = 'test')
SELECT split, count(*) AS n, {r4("sqrt(avg(e * e))", "rmse")}, {r4("avg(abs(e))", "mae")}, {r4("1 - avg(e * e) / var_pop(target)", "r2")},
       reg_param, {r4("any_value(valid_metric)", "valid_metric")} FROM p GROUP BY split, reg_param""",
    ops="M8 (one-feature ridge grid, picked on a validation block)",
)
def q_ridge_grid_search(spark, sf):
    train, test = _train_test(spark, sf)
    inner = sp.chrono_split(train.drop("split", "_idx", "_n", "_blk"), 0.8, col="inner")
    fit_rows = inner.where(F.col("inner") == "train").drop("inner", "_idx", "_n", "_blk")
    valid = inner.where(F.col("inner") == "test").drop("inner", "_idx", "_n", "_blk")
    grid_of = lambda lr: rg.param_grid(lr, _GRID, [0.0], [100])
    model, params = rg.grid_search(fit_rows, valid, ["close"], "target", grid=grid_of)
    preds = rg.predictions(model, fit_rows, "target", "ridge", "train").unionByName(rg.predictions(model, test, "target", "ridge", "test"))
    m = mt.regression_metrics(preds, group=["split"]).drop("mse")
    return rounded(m.withColumns({k: F.lit(float(params[k])) for k in ("reg_param", "valid_metric")}))


def _seq_sets(spark, sf):
    b = ord_adj(spark, sf)
    seqs = sq.lookback_sequences(b, "close", SEQ_LOOK_BACK)
    s = materialize(sp.chrono_split(seqs), "seq-table")
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


@register("seq_regress", ops="M12 (look-back vectors -> linear regression), W11 J4")
def q_seq_regress(spark, sf):
    train, test = _seq_sets(spark, sf)
    model = rg.sequence_regressor(train, "lr")
    return rounded(rg.sequence_predict(model, test, model_name="seq_lr"))


@register("seq_regress_gbt", ops="M12 (look-back vectors -> gradient-boosted trees)")
def q_seq_regress_gbt(spark, sf):
    train, test = _seq_sets(spark, sf)
    model = rg.sequence_regressor(train, "gbt", maxIter=20, maxDepth=4)
    return rounded(rg.sequence_predict(model, test, model_name="seq_gbt"))


@register(
    "model_roundtrip",
    sql=f"WITH {SPLIT_CTE} SELECT symbol, date, CAST(0 AS DOUBLE) AS difference FROM sp WHERE split = 'test'",
    ops="S8 M13 (save, load, batch scoring: the difference from the model in memory)",
)
def q_model_roundtrip(spark, sf):
    train, test = _train_test(spark, sf)
    pipe, _ = rg.lr_pipeline(FEATURE_COLS, "target", regParam=0.01, elasticNetParam=0.0)
    path, model = scratch_path(spark, "lr-pipeline"), pipe.fit(train)
    rg.save_model(model, path)
    own = rg.predictions(model, test).select("symbol", "date", F.col("prediction").alias("own"))
    loaded = rg.predictions(rg.load_pipeline(path), test).join(own, ["symbol", "date"])
    return rounded(loaded.select("symbol", "date", F.abs(F.col("prediction") - F.col("own")).alias("difference")))


_BASE_SQL = f"""WITH {SPLIT_CTE},
base AS (SELECT symbol, date, split, target AS label, close AS pred_naive, ma_10 AS pred_ma FROM sp)"""


def _base(m):
    """Two predictors that SQL can define: the last close and the 10-bar mean."""
    return m.select("symbol", "date", "split", F.col("target").alias("label"), F.col("close").alias("pred_naive"),
                    F.col("ma_10").alias("pred_ma"))


@register(
    "stack_predictions",
    sql=f"""{_BASE_SQL},
m AS (SELECT symbol, avg(label) AS my, avg(pred_naive) AS ma, avg(pred_ma) AS mb, var_pop(pred_naive) AS aa,
        var_pop(pred_ma) AS bb, covar_pop(pred_naive, pred_ma) AS ab, covar_pop(pred_naive, label) AS ay,
        covar_pop(pred_ma, label) AS by_ FROM base WHERE split = 'train' GROUP BY symbol),
c AS (SELECT symbol, my, ma, mb, (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS c1,
        (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS c2 FROM m)
SELECT symbol, date, {r4("label", "label")}, {r4("pred_naive", "pred_naive")}, {r4("pred_ma", "pred_ma")},
       {r4("my - c1 * ma - c2 * mb + c1 * pred_naive + c2 * pred_ma", "stacked")}
FROM base JOIN c USING (symbol) WHERE split = 'test'""",
    ops="M15 (meta-regression over SQL-defined base predictors, fitted on train rows)",
)
def q_stack_predictions(spark, sf):
    base = _base(ml_table(spark, sf))
    coefs = en.stack_fit(base.where(F.col("split") == "train"), "label", ["pred_naive", "pred_ma"])
    stacked = en.stack_predict(base.where(F.col("split") == "test"), coefs, ["pred_naive", "pred_ma"])
    return rounded(stacked.select("symbol", "date", "label", "pred_naive", "pred_ma", "stacked"))


@register(
    "hybrid_weights",
    sql=f"""{_BASE_SQL}
SELECT symbol, date, {r4("0.3 * pred_naive + 0.7 * pred_ma", "hybrid")} FROM base WHERE split = 'test'""",
    ops="M14 (the weights, over SQL-defined predictors in the two models' places)",
)
def q_hybrid_weights(spark, sf):
    test = _base(ml_table(spark, sf)).where(F.col("split") == "test")
    both = en.hybrid(test.select("symbol", "date", "pred_naive"), test.select("symbol", "date", "pred_ma"), "pred_naive", "pred_ma")
    return rounded(both.select("symbol", "date", "hybrid"))


def _fitted(spark, sf):
    """One model table with the look-back vector of each row (its last SEQ_LOOK_BACK closes) and a fold for train rows."""
    bars = ord_adj(spark, sf)
    m = model_table(spark, sf, bars)
    seqs = sq.lookback_sequences(bars, "close", SEQ_LOOK_BACK - 1).select("symbol", "date", F.concat("x", F.array("y")).alias("x"))
    folds = sp.time_folds(m.where(F.col("split") == "train").drop("_idx", "_n", "_blk"), 3).select("symbol", "date", "fold")
    rows = m.drop("_idx", "_n", "_blk").join(seqs, ["symbol", "date"]).join(folds, ["symbol", "date"], "left")
    return materialize(rows.withColumn("y", F.col("target")), "fitted-table")


def _both_models(train, score):
    """Linear regression and sequence model fitted on ``train``; their predictions side by side on ``score``."""
    pipe, _ = rg.lr_pipeline(FEATURE_COLS, "target", regParam=0.01, elasticNetParam=0.0)
    lr = rg.predictions(pipe.fit(train), score, "target", "lr", "x").select("symbol", "date", "label", F.col("prediction").alias("p_lr"))
    seq = rg.sequence_predict(rg.sequence_regressor(train, "lr"), score).select("symbol", "date", F.col("prediction").alias("p_seq"))
    return en.hybrid(lr, seq, "p_lr", "p_seq", out="p_hybrid")


def _long(wide, models: dict[str, str], *more):
    parts = [wide.select("symbol", "date", "label", F.col(c).cast("double").alias("prediction"), F.lit(name).alias("model"), *more) for name, c in models.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("model_comparison", ops="M14-M16 A12 D1 (fitted LR, sequence model, hybrid, out-of-fold stack, naive, one grouped pass)")
def q_model_comparison(spark, sf):
    t = _fitted(spark, sf)
    train, test = t.where(F.col("split") == "train"), t.where(F.col("split") == "test")
    scored = _both_models(train, t).join(t.select("symbol", "date", "split", "close", "ma_10"), ["symbol", "date"])
    oof = reduce(lambda a, b: a.unionByName(b), [_both_models(train.where(F.col("fold") != f), train.where(F.col("fold") == f)) for f in range(3)])
    coefs = en.stack_fit(oof, "label", ["p_lr", "p_seq"])
    wide = en.stack_predict(scored, coefs, ["p_lr", "p_seq"])
    names = {"lr": "p_lr", "seq_lr": "p_seq", "hybrid": "p_hybrid", "stack": "stacked", "naive": "close", "ma_10": "ma_10"}
    return rounded(en.compare_models(_long(wide, names, "split"), group=["model", "split"]))


@register("hybrid_blend", ops="M14 J2 M16 (0.7 x sequence model + 0.3 x linear regression, joined on key)")
def q_hybrid_blend(spark, sf):
    t = _fitted(spark, sf)
    both = _both_models(t.where(F.col("split") == "train"), t.where(F.col("split") == "test"))
    return rounded(en.compare_models(_long(both, {"lr": "p_lr", "seq_lr": "p_seq", "hybrid": "p_hybrid"}), group=["model"]))


_RIDGE = [0.01, 0.1, 1.0]
_FOLD_SQL = f"""WITH {SPLIT_CTE},
tr AS (SELECT symbol, date, close AS x, target AS y, row_number() OVER ({part()}) - 1 AS i,
        count(*) OVER (PARTITION BY symbol) AS m FROM sp WHERE split = 'train'),
f AS (SELECT x, y, CAST(floor(i * 3 / m) AS INTEGER) AS fold FROM tr)"""


@register(
    "ridge_cv",
    sql=f"""{_FOLD_SQL},
g AS (SELECT k.fold, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / var_pop(x) AS slope, stddev_pop(y) AS sy
      FROM (SELECT DISTINCT fold FROM f) k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
r AS (SELECT unnest([{", ".join(map(str, _RIDGE))}]) AS reg_param),
fits AS (SELECT reg_param, fold, slope / (1 + reg_param / sy) AS beta, mx, my FROM g, r),
e AS (SELECT reg_param, fold, sqrt(avg((y - my - beta * (x - mx)) ** 2)) AS rmse FROM fits JOIN f USING (fold) GROUP BY reg_param, fold)
SELECT CAST(reg_param AS DOUBLE) AS reg_param, {r4("avg(rmse)", "cv_rmse")} FROM e GROUP BY reg_param""",
    ops="M6 M7 (one-feature ridge grid over three time folds)",
)
def q_ridge_cv(spark, sf):
    train, _ = _train_test(spark, sf)
    folds = sp.time_folds(train, 3).drop("_idx", "_n", "_blk")
    grid_of = lambda lr: rg.param_grid(lr, _RIDGE, [0.0], [100])
    model, grid, lr = rg.cross_validate(folds, ["close"], "target", grid=grid_of)
    rows = [(float(m[lr.regParam]), float(v)) for m, v in zip(grid, model.avgMetrics)]
    return rounded(spark.createDataFrame(rows, "reg_param double, cv_rmse double"))


@register(
    "ridge_coefficients",
    sql=f"""WITH {SPLIT_CTE},
m AS (SELECT min(close) AS lo, max(close) AS hi, avg(close) AS mx, avg(target) AS my,
        covar_pop(close, target) / var_pop(close) / (1 + 0.1 / stddev_pop(target)) AS beta FROM sp WHERE split = 'train')
SELECT 'close' AS feature, {r4("beta * (hi - lo)", "coefficient")} FROM m
UNION ALL SELECT 'intercept', {r4("my - beta * (mx - lo)", "coefficient")} FROM m""",
    ops="S8 M5 (coefficient table of a fitted pipeline)",
)
def q_ridge_coefficients(spark, sf):
    train, _ = _train_test(spark, sf)
    pipe, _ = rg.lr_pipeline(["close"], "target", regParam=0.1, elasticNetParam=0.0)
    return rounded(rg.coefficients(pipe.fit(train), ["close"]))


_NET = [(reg, l1) for reg in (0.1, 1000.0, 20000.0, 1000000.0) for l1 in (0.5, 1.0)]


@register(
    "elastic_net_slopes",
    sql=f"""WITH {SPLIT_CTE},
m AS (SELECT max(close) - min(close) AS span, corr(close, target) AS r, stddev_pop(close) AS sx, stddev_pop(target) AS sy FROM sp WHERE split = 'train'),
g(reg_param, l1_share) AS (VALUES {", ".join(f"(CAST({reg} AS DOUBLE), CAST({l1} AS DOUBLE))" for reg, l1 in _NET)}),
w AS (SELECT reg_param, l1_share, sign(r) * greatest(abs(r) - reg_param * l1_share / sy, 0) / (1 + reg_param * (1 - l1_share) / sy) * sy / sx AS slope FROM m, g)
SELECT reg_param, l1_share, {r4("slope", "slope")} FROM w""",
    ops="M5 (elastic net and lasso of one feature against the soft threshold)",
)
def q_elastic_net_slopes(spark, sf):
    train, _ = _train_test(spark, sf)
    span = train.agg(F.max("close") - F.min("close")).first()[0]  # the pipeline scales the feature to 0..1

    def slope(reg, l1):
        pipe, _ = rg.lr_pipeline(["close"], "target", regParam=reg, elasticNetParam=l1, tol=1e-12)
        return float(pipe.fit(train).stages[-1].coefficients[0]) / span

    return rounded(spark.createDataFrame([(reg, l1, slope(reg, l1)) for reg, l1 in _NET], "reg_param double, l1_share double, slope double"))


@register(
    "ridge_predict_saved",
    sql=f"""WITH {SPLIT_CTE},
m AS (SELECT avg(close) AS mx, avg(target) AS my, covar_pop(close, target) / var_pop(close) / (1 + 0.1 / stddev_pop(target)) AS beta FROM sp WHERE split = 'train')
SELECT symbol, date, {r4("my + beta * (close - mx)", "prediction")} FROM sp, m WHERE split = 'test'""",
    ops="M4 M13 S8 (fitted, saved, loaded again; predictions against the closed form)",
)
def q_ridge_predict_saved(spark, sf):
    train, test = _train_test(spark, sf)
    pipe, _ = rg.lr_pipeline(["close"], "target", regParam=0.1, elasticNetParam=0.0)
    path = scratch_path(spark, "ridge-model")
    rg.save_model(pipe.fit(train), path)
    return rounded(rg.predictions(rg.load_pipeline(path), test, "target", "ridge", "test").select("symbol", "date", "prediction"))
