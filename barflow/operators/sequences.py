"""Differencing, look-back sequences and derived open, on the halo layout.

Sequence rows carry their own target date, so predictions made from them join
back to bars by key, never by position.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import comb

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators import halo


def difference(df: DataFrame, col: str = "close", d: int = 1, keys: Sequence[str] = ("symbol",),
               order: str = "date", out: str | None = None, dropna: bool = True,
               block: float | None = None) -> DataFrame:
    """d-th order difference of ``col`` (binomial form over d lags); first d rows dropped."""
    keys = list(keys)
    out = out or f"diff_{d}"
    h = halo.blocked(df, keys, order, preceding=d, block=block)
    w = halo.block_window(keys)
    expr = F.col(col)
    for j in range(1, d + 1):
        expr = expr + F.lit(float((-1) ** j * comb(d, j))) * F.lag(col, j).over(w)
    h = halo.drop_helpers(halo.core(h.withColumn(out, expr)))
    return h.where(F.col(out).isNotNull()) if dropna else h


def lookback_sequences(df: DataFrame, col: str = "close", look_back: int = 1, keys: Sequence[str] = ("symbol",),
                       order: str = "date", drop_last: bool = False,
                       block: float | None = None, dtype: str = "double") -> DataFrame:
    """Rows ``(keys, order, x, y)``: ``x`` = the previous ``look_back`` values, ``y`` = the current one.

    N - L rows per series (N - L - 1 with ``drop_last``, the notebook variant).
    NULL values are removed first, as a window collect would skip them.
    ``dtype="float"`` gives float32 sequences (tensor-ready); default double.
    """
    keys = list(keys)
    base = df.where(F.col(col).isNotNull()).select(*keys, order, col)
    h = halo.blocked(base, keys, order, preceding=look_back, following=1 if drop_last else 0,
                     block=block)
    w = halo.block_window(keys)
    h = h.withColumns(
        {
            "x": F.collect_list(F.col(col).cast(dtype)).over(w.rowsBetween(-look_back, -1)),
            "_has_next": F.lead(order, 1).over(w).isNotNull(),
        }
    )
    h = halo.core(h).where(F.size("x") == look_back)
    if drop_last:
        h = h.where(F.col("_has_next"))
    return h.select(*keys, order, "x", F.col(col).cast(dtype).alias("y"))


def sequences_to_columns(seq: DataFrame, look_back: int, prefix: str = "x_") -> DataFrame:
    """Spread the ``x`` array into ``x_1 .. x_L`` (oldest first)."""
    cols = [F.col("x")[i].alias(f"{prefix}{i + 1}") for i in range(look_back)]
    return seq.select(*[c for c in seq.columns if c != "x"], *cols)
