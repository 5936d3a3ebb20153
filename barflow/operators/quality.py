"""Shape, descriptive statistics, NULL handling and data-quality rules.

Every report is one aggregate pass with partial (map-side) aggregation, turned
into long form with ``stack`` so the number of output rows is the number of
columns, not the number of input rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from barflow.operators import halo
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def shape(df: DataFrame) -> DataFrame:
    """``n_rows, n_cols`` as a one-row DataFrame (one count job)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))


def _stack(wide: DataFrame, names: list[str], fields: list[str], keys: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``<col>__<field>`` columns into rows ``column, field...``."""
    parts = []
    for n in names:
        parts.append(f"'{n}'")
        parts.extend(f"`{n}__{f}`" for f in fields)
    expr = f"stack({len(names)}, {', '.join(parts)}) AS (`column`, {', '.join('`' + f + '`' for f in fields)})"
    return wide.selectExpr(*[f"`{k}`" for k in keys], expr)


def describe(df: DataFrame, cols: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Typed ``describe()``: ``column, count, mean, stddev, min, max`` per column (and key)."""
    cols = list(cols) if cols else numeric_columns(df, exclude=keys)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__stddev"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
    wide = df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)
    return _stack(wide, cols, ["count", "mean", "stddev", "min", "max"], keys)


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, one column per input column: the number of NULLs in it."""
    cols = list(cols) if cols else df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows with no NULL in ``subset`` (all columns by default)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def sum_by_key(df: DataFrame, keys: Sequence[str] = ("symbol", "date"), col: str = "close") -> DataFrame:
    """Collapse duplicate keys: ``sum(col)`` and the row count per key."""
    return df.groupBy(*keys).agg(F.sum(col).alias(f"sum_{col}"), F.count(F.lit(1)).alias("n_rows"))


def _row_rules(cols: set[str]) -> dict[str, Column]:
    """The rules that a row breaks by itself, for the columns there are."""
    out = {}
    if "close" in cols:
        out["null_close"] = F.col("close").isNull()
    if "volume" in cols:
        out["null_volume"] = F.col("volume").isNull()
        out["negative_volume"] = F.col("volume") < 0
    if {"high", "low"} <= cols:
        out["high_below_low"] = F.col("high") < F.col("low")
    if {"high", "low", "close"} <= cols:
        out["close_outside_range"] = (F.col("close") > F.col("high")) | (F.col("close") < F.col("low"))
    if "close" in cols:
        out["non_positive_close"] = F.col("close") <= 0
    return out


def observed_rules(df: DataFrame, name: str = "quality") -> tuple[DataFrame, Observation]:
    """``df`` that counts its rows and broken rules while it is written: no scan of its own.

    The counts are those of ``quality_rules`` over the whole table but for
    duplicate keys, which need an exchange. ``observation.get`` has them after the
    first action on the frame (a write, say).
    """
    seen = Observation(name)
    rules = [F.count_if(c).alias(rule) for rule, c in _row_rules(set(df.columns)).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *rules), seen


def quality_rules(df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "date") -> DataFrame:
    """Per key: rows, NULL prices, duplicate ``(key, order)`` rows and rule violations.

    Duplicates are counted in two aggregation levels (per key+order, then per
    key) so no distinct set is ever held for a whole key.
    """
    keys = list(keys)
    cols = set(df.columns)
    per_obs = df.groupBy(*keys, order).agg(F.count(F.lit(1)).alias("_c"))
    dups = per_obs.groupBy(*keys).agg(
        F.sum(F.col("_c") - 1).alias("dup_key_rows"), F.count(F.lit(1)).alias("n_distinct_dates")
    )
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(rule) for rule, c in _row_rules(cols).items()]]
    rules = df.groupBy(*keys).agg(*aggs)
    return halo.join_null_safe(rules, dups, keys)  # rows with a NULL key are reported too
