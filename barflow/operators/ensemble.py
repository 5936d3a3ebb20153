"""Blending, stacking and model comparison over prediction tables.

Predictions are joined on ``(symbol, date)``, never paired by position.
Stacking fits its meta-regression on out-of-fold base predictions (the
reference fits it with the true label as a feature, which only learns to copy
it); the two-regressor least squares is solved from grouped sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators import halo
from barflow.operators.metrics import regression_metrics


def blend(a: DataFrame, b: DataFrame, col_a: str, col_b: str, w_a: float = 0.7, w_b: float = 0.3,
          keys: Sequence[str] = ("symbol", "date"), out: str = "blend") -> DataFrame:
    """Inner join on keys, ``out = w_a * a + w_b * b``."""
    j = a.join(b, list(keys))
    return j.withColumn(out, F.lit(w_a) * F.col(col_a) + F.lit(w_b) * F.col(col_b))


# The reference's hybrid weights.
HYBRID_LR, HYBRID_SEQUENCE = 0.3, 0.7


def hybrid(lr: DataFrame, sequence: DataFrame, col_lr: str, col_sequence: str, keys: Sequence[str] = ("symbol", "date"),
           out: str = "hybrid") -> DataFrame:
    """``0.7 x sequence model + 0.3 x linear regression``, joined on keys."""
    return blend(lr, sequence, col_lr, col_sequence, HYBRID_LR, HYBRID_SEQUENCE, keys, out)


def stack_fit(oof: DataFrame, label: str, cols: Sequence[str], group: Sequence[str] = ("symbol",)) -> DataFrame:
    """Least squares ``label ~ 1 + a + b`` per group from central moments (one grouped aggregate).

    ``oof`` holds out-of-fold base predictions. Returns ``c0, c1, c2``; all are
    NULL where the two predictors are collinear or constant in a group.
    """
    a, b = (F.when(F.col(label).isNotNull() & F.col(cols[0]).isNotNull() & F.col(cols[1]).isNotNull(), F.col(c)) for c in cols)
    y = F.when(a.isNotNull(), F.col(label))
    m = oof.groupBy(*group).agg(
        F.avg(y).alias("my"), F.avg(a).alias("ma"), F.avg(b).alias("mb"), F.var_pop(a).alias("aa"), F.var_pop(b).alias("bb"),
        F.covar_pop(a, b).alias("ab"), F.covar_pop(a, y).alias("ay"), F.covar_pop(b, y).alias("by"),
    )
    det = F.expr("aa * bb - ab * ab")
    det = F.when(det > F.expr("1e-12 * aa * bb"), det)
    m = m.withColumns({"c1": F.try_divide(F.expr("ay * bb - by * ab"), det), "c2": F.try_divide(F.expr("by * aa - ay * ab"), det)})
    return m.select(*group, F.expr("my - c1 * ma - c2 * mb").alias("c0"), "c1", "c2")


def stack_predict(df: DataFrame, coefs: DataFrame, cols: Sequence[str], group: Sequence[str] = ("symbol",),
                  out: str = "stacked") -> DataFrame:
    a, b = cols
    j = halo.join_null_safe(df, coefs, list(group))
    return j.withColumn(out, F.col("c0") + F.col("c1") * F.col(a) + F.col("c2") * F.col(b)).drop("c0", "c1", "c2")


def compare_models(pred_long: DataFrame, label: str = "label", prediction: str = "prediction",
                   group: Sequence[str] = ("model", "split")) -> DataFrame:
    """Metrics per model (and split): one grouped pass over all models at once."""
    return regression_metrics(pred_long, label, prediction, group)
