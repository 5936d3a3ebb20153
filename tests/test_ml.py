"""Spark ML regression paths: cross-validation and grid search against plain numpy."""

import numpy as np
import pandas as pd
import pytest

from barflow.operators import gram as gm
from barflow.operators import regress as rg


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 600
    x = rng.normal(size=(n, 4)) * np.array([1.0, 3.0, 0.5, 2.0]) + np.array([5, -2, 0, 1])
    y = 3 + x @ np.array([1.5, -0.7, 0.0, 2.0]) + rng.normal(scale=2.0, size=n)
    pdf = pd.DataFrame(x, columns=["a", "b", "c", "d"])
    pdf["y"] = y
    pdf["fold"] = np.arange(n) * 3 // n
    return pdf


def _ridge(x, y, reg):
    """One feature: the slope that Spark ML's standardised ridge has in closed form."""
    beta = np.cov(x, y, bias=True)[0, 1] / np.var(x) / (1 + reg / np.std(y))
    return y.mean() - beta * x.mean(), beta


def test_cross_validation_scores_equal_closed_form(spark, data):
    grid = lambda lr: rg.param_grid(lr, [0.01, 0.5], [0.0], [10, 100])
    model, maps, lr = rg.cross_validate(spark.createDataFrame(data), ["a"], "y", grid=grid)
    assert len(maps) == len(model.avgMetrics) == 4
    for m, got in zip(maps, model.avgMetrics):
        want = []
        for f in range(3):
            train, test = data[data.fold != f], data[data.fold == f]
            b0, b1 = _ridge(train.a.to_numpy(), train.y.to_numpy(), m[lr.regParam])
            want.append(np.sqrt(np.mean((test.y - b0 - b1 * test.a) ** 2)))
        assert got == pytest.approx(np.mean(want), rel=1e-9)
    best = rg.best_params(model, maps, lr)
    assert best["cv_metric"] == min(model.avgMetrics)
    assert model.transform(spark.createDataFrame(data)).count() == len(data)


def test_cross_validation_covers_the_whole_grid_and_random_folds(spark, data):
    model, maps, _ = rg.cross_validate(spark.createDataFrame(data.head(200)), ["a", "b"], "y", fold_col=None, metric="r2")
    assert len(maps) == 27 == len(model.avgMetrics) and model.isLargerBetter
    assert max(model.avgMetrics) <= 1


def test_grid_search_picks_the_best_on_validation_rows(spark, data):
    frame = spark.createDataFrame(data)
    model, params = rg.grid_search(frame.where("fold < 2"), frame.where("fold = 2"), ["a", "b", "c", "d"], "y")
    assert params["reg_param"] in rg.REG_PARAMS and params["elastic_net_param"] in rg.ELASTIC_NET_PARAMS
    out = model.transform(frame.where("fold = 2")).select("y", "prediction").toPandas()
    assert params["valid_metric"] == pytest.approx(np.sqrt(((out.y - out.prediction) ** 2).mean()), rel=1e-9)


def test_rank_deficient_systems_have_no_solution():
    x = np.column_stack([np.ones(30), np.arange(30.0), 2 * np.arange(30.0)])
    y = np.arange(30.0) ** 2
    beta, se, ssr = gm.ols_from_gram(x.T @ x, x.T @ y, float(y @ y), 30)
    assert np.isnan(beta).all() and np.isnan(se).all() and np.isnan(ssr)
    level = 1e5 + np.arange(30.0)
    x = np.column_stack([np.ones(30), level, np.sin(level)])
    beta, _, ssr = gm.ols_from_gram(x.T @ x, x.T @ y, float(y @ y), 30)
    want = np.linalg.lstsq(x - np.array([0, 1e5, 0]), y, rcond=None)[0]
    assert beta[1] == pytest.approx(want[1], rel=1e-4)


def test_concurrent_fits_keep_order_pools_and_errors(spark):
    sc = spark.sparkContext
    sc.setLocalProperty("barflow.test", "outer")
    try:
        pools = rg.concurrently(spark, [lambda i=i: (i, sc.getLocalProperty("spark.scheduler.pool"), sc.getLocalProperty("barflow.test"), spark.range(i).count()) for i in range(6)], most=3)
    finally:
        sc.setLocalProperty("barflow.test", None)
    assert pools == [(i, f"fit-{i % 3}", "outer", i) for i in range(6)]
    assert sc.getLocalProperty("spark.scheduler.pool") is None  # the caller's own is untouched
    with pytest.raises(ZeroDivisionError):
        rg.concurrently(spark, [lambda: 1, lambda: 1 // 0])


def test_repeated_cross_validations_are_equal(spark, data):
    frame = spark.createDataFrame(data.head(300).assign(fold=lambda d: range(len(d))).assign(fold=lambda d: d["fold"] % 3))
    metrics = []
    for _ in range(3):
        model, _, _ = rg.cross_validate(frame.coalesce(1), ["a", "b"], "y", grid=lambda lr: rg.param_grid(lr, [0.1, 1.0], [0.0, 0.5], [10]))
        metrics.append(model.avgMetrics)
    assert metrics[0] == metrics[1] == metrics[2]
