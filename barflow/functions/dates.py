"""Date helpers: ISO formatting, forecast calendars."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def iso_date(col: str | Column) -> Column:
    """``yyyy-MM-dd`` text of a date/timestamp (output formatting only)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd")


def parse_date(col: str | Column, fmt: str | None = None) -> Column:
    """Text to date; malformed input gives NULL instead of an ANSI error."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date") if fmt else F.try_to_timestamp(c).cast("date")


def future_dates(df: DataFrame, horizon: int = 30, keys: Sequence[str] = ("symbol",), order: str = "date",
                 skip_weekends: bool = False) -> DataFrame:
    """``keys, step, date`` for the ``horizon`` calendar days after each key's last date.

    With ``skip_weekends`` the steps walk business days (Mon-Fri) instead.
    """
    last = df.groupBy(*keys).agg(F.max(order).alias("_last"))
    if not skip_weekends:
        steps = last.select(*keys, "_last", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"))
        return steps.select(*keys, F.col("step").cast("int"), F.date_add("_last", F.col("step")).alias(order))
    # enough calendar days to contain `horizon` business days
    span = horizon + 2 * (horizon // 5) + 4
    days = last.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(span))).alias("_k"), "_last")
    days = days.withColumn(order, F.date_add("_last", F.col("_k"))).where(~F.dayofweek(order).isin(1, 7))
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy(order)  # at most `span` rows per key
    days = days.withColumn("step", F.row_number().over(w).cast("int"))
    return days.where(F.col("step") <= horizon).select(*keys, "step", order)
