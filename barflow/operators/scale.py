"""Min-max scaling fitted on training rows, and its inverse.

``fit_minmax`` is one grouped aggregate (one row per key); applying it is a
join on the key that AQE broadcasts when the stats table is small and plans as
a shuffle join (with skew splitting) otherwise. A constant column maps to 0.5,
the value Spark ML's ``MinMaxScaler`` gives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_minmax(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",), where=None) -> DataFrame:
    src = df.where(where) if where is not None else df
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}_min"), F.max(x).alias(f"{c}_max")]
    return src.groupBy(*keys).agg(*aggs) if keys else src.agg(*aggs)


def _attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join per-key stats; global stats (no keys) are one row, read once as literals."""
    if keys:
        return df.join(stats, list(keys))
    row = stats.first()
    return df.withColumns({c: F.lit(row[c]).cast("double") for c in stats.columns})


def apply_minmax(df: DataFrame, stats: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",),
                 suffix: str = "_scaled", lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    j = _attach(df, stats, keys)
    out = {}
    for c in cols:
        mn, mx = F.col(f"{c}_min"), F.col(f"{c}_max")
        unit = F.when(mx == mn, F.lit(0.5)).otherwise((F.col(c).cast("double") - mn) / (mx - mn))
        out[f"{c}{suffix}"] = unit * F.lit(hi - lo) + F.lit(lo)
    drop = [f"{c}_{s}" for c in cols for s in ("min", "max")]
    return j.withColumns(out).drop(*drop)


def inverse_minmax(df: DataFrame, stats: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",),
                   suffix: str = "_scaled", out_suffix: str = "_restored", lo: float = 0.0,
                   hi: float = 1.0) -> DataFrame:
    """``x = min + (s - lo) / (hi - lo) * (max - min)``."""
    j = _attach(df, stats, keys)
    out = {}
    for c in cols:
        mn, mx = F.col(f"{c}_min"), F.col(f"{c}_max")
        unit = (F.col(f"{c}{suffix}") - F.lit(lo)) / F.lit(hi - lo)
        out[f"{c}{out_suffix}"] = mn + unit * (mx - mn)
    drop = [f"{c}_{s}" for c in cols for s in ("min", "max")]
    return j.withColumns(out).drop(*drop)


def scale_and_save(spark, train: DataFrame, test: DataFrame, cols: Sequence[str], out_dir: str,
                   keys: Sequence[str] = ("symbol",), fmt: str = "parquet"):
    """Fit on train, transform both, write ``train``/``test``/``scaler`` under ``out_dir``."""
    stats = fit_minmax(train, cols, keys)
    tr, te = apply_minmax(train, stats, cols, keys), apply_minmax(test, stats, cols, keys)
    for name, d in (("train", tr), ("test", te), ("scaler", stats)):
        d.write.mode("overwrite").format(fmt).option("header", True).save(f"{out_dir}/{name}")
    return tr, te, stats
