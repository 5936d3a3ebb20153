"""Spark ML regression: pipelines, cross-validation, grid search, sequence models.

The estimator work is Spark ML's: with a dozen features ``LinearRegression``
solves from one aggregate of the data. The training set is persisted around
cross-validation so that fits do not rescan the feature build. Folds are time blocks by default (a random fold over a time
series leaks the future into training).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.sources.schema import FEATURE_COLS

# The reference's search grid (3 x 3 x 3 = 27 maps).
REG_PARAMS = [0.01, 0.1, 1.0]
ELASTIC_NET_PARAMS = [0.0, 0.5, 1.0]
MAX_ITERS = [10, 100, 200]


def lr_pipeline(features: Sequence[str] = FEATURE_COLS, label: str = "target", scale: bool = True,
                **lr_params) -> tuple[Pipeline, LinearRegression]:
    """Assembler -> min-max scaler (fitted on the training rows) -> linear regression."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")]
    feat = "features"
    if scale:
        stages.append(MinMaxScaler(inputCol="features", outputCol="scaled_features"))
        feat = "scaled_features"
    lr = LinearRegression(featuresCol=feat, labelCol=label, predictionCol="prediction", **lr_params)
    stages.append(lr)
    return Pipeline(stages=stages), lr


def param_grid(lr: LinearRegression, reg=REG_PARAMS, enet=ELASTIC_NET_PARAMS, iters=MAX_ITERS):
    """The 27-map grid."""
    return (
        ParamGridBuilder()
        .addGrid(lr.regParam, list(reg))
        .addGrid(lr.elasticNetParam, list(enet))
        .addGrid(lr.maxIter, list(iters))
        .build()
    )


def _prepared(train: DataFrame, features, label):
    """Assembler and scaler fitted once, and the regression on their output."""
    prep = Pipeline(stages=lr_pipeline(features, label)[0].getStages()[:-1]).fit(train)
    return prep, LinearRegression(featuresCol="scaled_features", labelCol=label, predictionCol="prediction")


def _fit_key(lr: LinearRegression, m) -> tuple:
    """Maps with one key give the same model: without an L1 part the solver is closed-form and maxIter unused."""
    return m[lr.regParam], m[lr.elasticNetParam], None if m[lr.elasticNetParam] == 0 else m[lr.maxIter]


#: Fits that run side by side. Each is a small job; one alone leaves most task slots idle.
CONCURRENT_FITS = 8


def concurrently(spark, jobs: Sequence[Callable], most: int = CONCURRENT_FITS) -> list:
    """Results of the jobs (functions without arguments that run Spark jobs), in order, ``most`` at a time.

    Each job runs in a thread that inherits the caller's job properties and has a
    scheduler pool of its own, so with ``spark.scheduler.mode=FAIR`` the jobs
    share the slots evenly. The first error is raised once all have ended.
    """
    def pooled(number: int, job: Callable):
        def run():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit-{number % most}")
            return job()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_workers=most) as threads:
        return [f.result() for f in [threads.submit(pooled(i, job)) for i, job in enumerate(jobs)]]


def _distinct_fits(lr: LinearRegression, grid) -> dict:
    """One map for each distinct model of the grid."""
    return {_fit_key(lr, m): m for m in grid}


def _fit_each(lr: LinearRegression, rows: DataFrame, grid) -> dict:
    """One fitted model for each distinct key of the grid."""
    maps = _distinct_fits(lr, grid)
    fits = [lambda m=m: lr.copy(m).fit(rows) for m in maps.values()]
    return dict(zip(maps, concurrently(rows.sparkSession, fits)))


def _score_each(models: dict, rows: DataFrame, label: str, metric: str) -> dict:
    """The metric of every model on ``rows``, all in one aggregate over the scaled features."""
    x = vector_to_array("scaled_features")
    y = F.col(label).cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.var_pop(y).alias("var")]
    for i, model in enumerate(models.values()):
        p = F.lit(float(model.intercept))
        for j, c in enumerate(model.coefficients.toArray()):
            p = p + F.lit(float(c)) * x[j]
        aggs += [F.sum((y - p) * (y - p)).alias(f"sse{i}"), F.sum(F.abs(y - p)).alias(f"sae{i}")]
    r = rows.agg(*aggs).first()
    n, var = r["n"], r["var"]

    def value(i):
        if not n:
            return float("nan")
        mse = r[f"sse{i}"] / n
        return {"rmse": mse**0.5, "mse": mse, "mae": r[f"sae{i}"] / n, "r2": 1 - mse / var if var else float("nan")}[metric]

    return {key: value(i) for i, key in enumerate(models)}


def cross_validate(train: DataFrame, features: Sequence[str] = FEATURE_COLS, label: str = "target",
                   fold_col: str | None = "fold", num_folds: int = 3, seed: int = 42, metric: str = "rmse",
                   grid=None):
    """k-fold CV of the regression over the grid; returns ``(model, grid, lr)``.

    As in the reference, the assembler and min-max scaler are fitted once on the
    training rows and only the regression is cross-validated; ``model`` is a
    ``PipelineModel`` (assembler, scaler, best regression refitted on all rows)
    with the mean metric of every map in ``avgMetrics``. With ``fold_col`` (int
    fold ids, e.g. from ``split.time_folds``) the folds are those time blocks;
    otherwise they are dealt by a seeded hash of the row. The fits of all folds run
    side by side over one persisted table (``concurrently``), then the scores.
    """
    prep, lr = _prepared(train, features, label)
    grid = param_grid(lr) if grid is None else grid(lr)
    fold = F.col(fold_col) if fold_col else F.pmod(F.xxhash64(F.lit(seed), *features, label), F.lit(num_folds))
    cached = prep.transform(train).select("scaled_features", label, fold.alias("_fold")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        folds = sorted(r[0] for r in cached.select("_fold").distinct().collect())  # k numbers
        maps = _distinct_fits(lr, grid)
        rest = {f: cached.where(F.col("_fold") != f) for f in folds}
        fits = concurrently(train.sparkSession, [lambda m=m, f=f: lr.copy(m).fit(rest[f]) for f in folds for m in maps.values()])
        by_fold = [dict(zip(maps, fits[i * len(maps) :])) for i in range(len(folds))]
        scores = concurrently(train.sparkSession, [lambda f=f, own=own: _score_each(own, cached.where(F.col("_fold") == f), label, metric) for f, own in zip(folds, by_fold)])
        mean = [sum(s[_fit_key(lr, m)] for s in scores) / len(scores) for m in grid]
        larger = metric == "r2"
        best = (max if larger else min)(range(len(grid)), key=mean.__getitem__)
        model = PipelineModel(stages=[*prep.stages, lr.copy(grid[best]).fit(cached)])
    finally:
        cached.unpersist()
    model.avgMetrics, model.isLargerBetter = mean, larger  # kept for best_params
    return model, grid, lr


def best_params(cv_model, grid, lr: LinearRegression) -> dict:
    metrics = list(cv_model.avgMetrics)
    larger = cv_model.isLargerBetter
    best = max(range(len(metrics)), key=lambda i: metrics[i]) if larger else min(range(len(metrics)), key=lambda i: metrics[i])
    m = grid[best]
    return {
        "reg_param": float(m[lr.regParam]),
        "elastic_net_param": float(m[lr.elasticNetParam]),
        "max_iter": int(m[lr.maxIter]),
        "cv_metric": float(metrics[best]),
    }


def grid_search(train: DataFrame, valid: DataFrame, features: Sequence[str] = FEATURE_COLS,
                label: str = "target", metric: str = "rmse", grid=None):
    """Fit every map of the grid (``grid``, a function of the regression, or the 27 maps) on ``train``, pick by ``valid`` (honouring larger-is-better).

    The assembler and scaler are fitted once, maps that give the same model are
    fitted once, and one aggregate scores all models. Returns ``(model, params)``
    with ``model`` a ``PipelineModel``.
    """
    prep, lr = _prepared(train, features, label)
    grid = param_grid(lr) if grid is None else grid(lr)
    fit_rows = prep.transform(train).select("scaled_features", label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = _fit_each(lr, fit_rows, grid)
        scores = _score_each(models, prep.transform(valid), label, metric)
    finally:
        fit_rows.unpersist()
    best = (max if metric == "r2" else min)(grid, key=lambda m: scores[_fit_key(lr, m)])
    params = {"reg_param": best[lr.regParam], "elastic_net_param": best[lr.elasticNetParam],
              "max_iter": best[lr.maxIter], "valid_metric": scores[_fit_key(lr, best)]}
    return PipelineModel(stages=[*prep.stages, models[_fit_key(lr, best)]]), params


def predictions(model, df: DataFrame, label: str = "target", model_name: str = "lr", split: str = "test",
                keys: Sequence[str] = ("symbol", "date")) -> DataFrame:
    """Long prediction table ``symbol, date, label, prediction, model, split``."""
    out = model.transform(df)
    return out.select(*keys, F.col(label).cast("double").alias("label"), F.col("prediction").cast("double"),
                      F.lit(model_name).alias("model"), F.lit(split).alias("split"))


def sequence_regressor(seqs: DataFrame, kind: str = "lr", **params):
    """Regressor on look-back vectors (``x`` array -> vector); ``kind`` = lr | gbt."""
    data = seqs.withColumn("features", array_to_vector("x"))
    est = (
        LinearRegression(featuresCol="features", labelCol="y", **params)
        if kind == "lr"
        else GBTRegressor(featuresCol="features", labelCol="y", seed=42, **params)
    )
    return est.fit(data)


def sequence_predict(model, seqs: DataFrame, keys=("symbol", "date"), model_name: str = "seq_lr",
                     split: str = "test") -> DataFrame:
    out = model.transform(seqs.withColumn("features", array_to_vector("x")))
    return out.select(*keys, F.col("y").alias("label"), F.col("prediction").cast("double"),
                      F.lit(model_name).alias("model"), F.lit(split).alias("split"))


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def coefficients(model, features: Sequence[str] = FEATURE_COLS) -> DataFrame:
    """``feature, coefficient`` rows of a fitted linear pipeline (plus intercept)."""
    from pyspark.sql import SparkSession

    lr = model.stages[-1] if hasattr(model, "stages") else model
    s = SparkSession.getActiveSession()
    rows = [(f, float(c)) for f, c in zip(features, lr.coefficients.toArray())] + [("intercept", float(lr.intercept))]
    return s.createDataFrame(rows, "feature string, coefficient double")
