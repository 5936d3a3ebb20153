"""Regression metrics and simple SQL-form regressions, grouped, in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                       group: Sequence[str] = ("symbol",)) -> DataFrame:
    """``n, mse, rmse, mae, r2`` per group (r2 = 1 - SSE / SST; SST = n * var_pop)."""
    e = F.col(label) - F.col(prediction)
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg(e * e).alias("mse"),
        F.avg(F.abs(e)).alias("mae"),
        F.sum(e * e).alias("_sse"),
        (F.var_pop(label) * F.count(F.lit(1))).alias("_sst"),
    ]
    m = pred.groupBy(*group).agg(*aggs) if group else pred.agg(*aggs)
    return m.withColumn("rmse", F.sqrt("mse")).withColumn(
        "r2", F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_sst"))
    ).drop("_sse", "_sst")


def ols_simple(df: DataFrame, y: str, x: str, group: Sequence[str] = ("symbol",)) -> DataFrame:
    """One-regressor least squares per group with the SQL ``regr_*`` aggregates."""
    return df.groupBy(*group).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def inverse_scale_close(scaled: DataFrame, data: DataFrame, col: str = "close", scaled_col: str = "scaled") -> DataFrame:
    """Undo a [0, 1] min-max of ``col`` using the global min/max of ``data`` (one aggregate)."""
    mn, mx = data.agg(F.min(col), F.max(col)).first()  # two scalars, one aggregate job
    return scaled.withColumn(f"{col}_restored", F.lit(mn) + F.col(scaled_col) * F.lit(mx - mn))
