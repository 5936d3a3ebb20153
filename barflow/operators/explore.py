"""Exploration: date-range filters, KPIs, correlations, yearly distributions.

Everything is an aggregate with partial aggregation; plotting series are
downsampled on the cluster (``downsample``) before anything is collected.
"""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow import ensure_importable
from barflow.operators import halo, selection


def date_range(df: DataFrame, start=None, end=None, order: str = "date") -> DataFrame:
    """Inclusive ``start <= order <= end``; either bound may be None (open).

    A bound that is a calendar day (a date, or text without a time) takes the
    whole day, also on a timestamp column; the filter still reaches the scan.
    """
    c, kind = F.col(order), df.schema[order].dataType
    if start is not None:
        df = df.where(c >= F.lit(start).cast(kind))
    if end is not None:
        if _is_day(end) and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            df = df.where(c < F.date_add(F.lit(end).cast("date"), 1).cast(kind))
        else:
            df = df.where(c <= F.lit(end).cast(kind))
    return df


def _is_day(bound) -> bool:
    if isinstance(bound, str):
        return len(bound.strip()) <= 10
    return isinstance(bound, dt.date) and not isinstance(bound, dt.datetime)


def is_empty(df: DataFrame) -> bool:
    """Whether a frame, as after a filter, has no row; one row is looked for, nothing is counted."""
    return df.isEmpty()


def date_bounds(df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "date") -> DataFrame:
    return df.groupBy(*keys).agg(F.min(order).alias("first_date"), F.max(order).alias("last_date"))


def price_kpis(df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "date") -> DataFrame:
    """Mean close, highest high, lowest low, first/last close and period change in %."""
    first = F.min_by("close", order)
    last = F.max_by("close", order)
    return df.groupBy(*keys).agg(
        F.avg("close").alias("mean_close"),
        F.max("high").alias("max_high"),
        F.min("low").alias("min_low"),
        F.count(F.lit(1)).alias("n_bars"),
        first.alias("first_close"),
        last.alias("last_close"),
        F.try_divide((last - first) * F.lit(100.0), first).alias("change_pct"),
    )


def price_summary(df: DataFrame, start=None, end=None, keys: Sequence[str] = ("symbol",),
                  order: str = "date") -> DataFrame:
    """Dashboard summary: filter (pushed to the scan) + one aggregate."""
    return price_kpis(date_range(df, start, end, order), keys, order)


def corr_matrix(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Pearson correlation of every column pair, long form ``col_a, col_b, corr``."""
    pairs = list(itertools.combinations(cols, 2))
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    parts = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(*keys, f"stack({len(pairs)}, {parts}) AS (col_a, col_b, corr)")


def corr_wide(df: DataFrame, cols: Sequence[str], columns: int = 64) -> DataFrame:
    """As ``corr_matrix`` over the whole table, for hundreds of columns.

    Each task adds up, for every pair of columns, the count, sums, squares and
    product of the rows where both are there (matrix products of its batches,
    values less the column's mean), a row for each column and block of
    ``columns`` others. The tasks' sums are added by a Spark aggregate; a plan
    with an aggregate for each pair would not compile. A column that does not
    vary where both are there has a NULL correlation.
    """
    cols = list(cols)
    k = len(cols)
    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    centre = [v or 0.0 for v in x.agg(*[F.avg(c) for c in x.columns]).first()]  # k numbers; any centre gives the same result
    ensure_importable(df.sparkSession)

    def sums(batches):
        total = None
        for batch in batches:
            v = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns], axis=1) - centre
            there = (~np.isnan(v)).astype(float)
            v = np.nan_to_num(v, nan=0.0)
            own = np.stack([there.T @ there, v.T @ there, there.T @ v, (v * v).T @ there, there.T @ (v * v), v.T @ v], axis=-1)
            total = own if total is None else total + own
        if total is not None:
            for i in range(k):
                for lo in range(i + 1, k, columns):
                    part = total[i, lo : lo + columns]
                    yield pa.record_batch([pa.array([i], pa.int32()), pa.array([lo], pa.int32()), pa.array([part.ravel().tolist()], pa.list_(pa.float64()))], names=["i", "lo", "s"])

    cells = x.mapInArrow(sums, "i int, lo int, s array<double>").select("i", "lo", F.posexplode("s").alias("at", "v"))
    pair = cells.groupBy("i", (F.col("lo") + F.floor(F.col("at") / 6)).cast("int").alias("j"))
    n, sx, sy, sxx, syy, sxy = (F.sum(F.when(F.col("at") % 6 == f, F.col("v"))) for f in range(6))
    pair = pair.agg(n.alias("n"), sx.alias("sx"), sy.alias("sy"), sxx.alias("sxx"), syy.alias("syy"), sxy.alias("sxy"))
    vx, vy = (F.greatest(F.col(q) - F.try_divide(F.col(s) * F.col(s), F.col("n")), F.lit(0.0)) for q, s in (("sxx", "sx"), ("syy", "sy")))
    corr = F.try_divide(F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n")), F.sqrt(vx * vy))
    name = lambda c: F.element_at(F.array(*map(F.lit, cols)), F.col(c) + 1)
    return pair.select(name("i").alias("col_a"), name("j").alias("col_b"), corr.alias("corr"))


def _period(df: DataFrame, order: str, by: str) -> DataFrame:
    if by == "all":
        return df.withColumn(by, F.lit("all"))
    return df.withColumn(by, F.year(order)) if by == "year" else df


def quartiles(df: DataFrame, col: str = "close", keys: Sequence[str] = ("symbol",), order: str = "date",
              by: str = "year", accuracy: int | None = None, bound: int | None = None) -> DataFrame:
    """``q1, median, q3, iqr`` per key and period (``by``: year, all, or a column).

    Exact (linear interpolation) by default, in one aggregate; its value map is
    bounded by the bars of a period, which fits daily bars. For minute or tick
    bars pass ``bound``: the same numbers by histogram refinement
    (``selection.exact_percentiles``), where no task holds more than ``bound``
    values of a group. ``accuracy`` uses the approximate percentile instead (a
    sketch; the rank error is at most n / accuracy).
    """
    g, at = [*keys, by], F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    if bound is not None:
        out = selection.exact_percentiles(_period(df, order, by), g, col, (0.25, 0.5, 0.75), bound).withColumnRenamed("q", "_q")
        out = out.select(*g, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
        return out.withColumn("iqr", F.col("q3") - F.col("q1"))
    q = F.percentile(F.col(col), at) if accuracy is None else F.percentile_approx(F.col(col).cast("double"), at, accuracy)
    out = _period(df, order, by).groupBy(*g).agg(q.alias("_q"))
    out = out.select(*g, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3"))
    return out.withColumn("iqr", F.col("q3") - F.col("q1"))


def _fences():
    return F.col("q1") - F.lit(1.5) * F.col("iqr"), F.col("q3") + F.lit(1.5) * F.col("iqr")


def box_stats(df: DataFrame, col: str = "close", keys: Sequence[str] = ("symbol",), order: str = "date",
              by: str = "year", accuracy: int | None = None, bound: int | None = None) -> DataFrame:
    """Box-plot numbers per key and period: quartiles, IQR, whiskers (furthest
    values within 1.5 IQR) and the outlier count. ``accuracy`` and ``bound`` as in ``quartiles``.
    """
    g = [*keys, by]
    joined = halo.join_null_safe(_period(df, order, by).select(*g, col), quartiles(df, col, keys, order, by, accuracy, bound), g)
    lo, hi = _fences()
    inside = (F.col(col) >= lo) & (F.col(col) <= hi)
    return joined.groupBy(*g, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_low"),
        F.max(F.when(inside, F.col(col))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"),
    )


def box_outliers(df: DataFrame, col: str = "close", keys: Sequence[str] = ("symbol",), order: str = "date",
                 accuracy: int | None = None) -> DataFrame:
    """Rows outside their (key, year) fences: one percentile aggregate and one join."""
    g = [*keys, "year"]
    q = quartiles(df, col, keys, order, "year", accuracy).select(*g, "q1", "q3", "iqr")
    lo, hi = _fences()
    joined = halo.join_null_safe(_period(df, order, "year"), q, g)
    return joined.where((F.col(col) < lo) | (F.col(col) > hi)).select(*keys, order, "year", col)


def downsample(df: DataFrame, unit: str = "month", cols: Sequence[str] = ("close",), keys: Sequence[str] = ("symbol",),
               order: str = "date") -> DataFrame:
    """Series for plotting: last value and mean per ``date_trunc(unit)`` bucket."""
    b = F.date_trunc(unit, F.col(order)).cast(df.schema[order].dataType)
    aggs = []
    for c in cols:
        aggs += [F.max_by(c, order).alias(f"last_{c}"), F.avg(c).alias(f"mean_{c}")]
    return df.groupBy(*keys, b.alias("period")).agg(*aggs)


def first_rows(df: DataFrame, n: int, keys: Sequence[str] = ("symbol",), order: str = "date") -> DataFrame:
    """First ``n`` rows of each key in order (top-k per key; bounded per group)."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
