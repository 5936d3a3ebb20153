"""Chronological splits and time-blocked folds, per key, in one pass.

The reference takes ``orderBy(date).limit(k)`` and then a set difference; a
global ``limit`` pulls k rows into one task. Here a row's contiguous position
``_idx`` and its key's length ``_n`` come from the halo layout, and the split
is a column: ``train`` when ``_idx < floor(frac * _n)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.operators import halo


def with_position(df: DataFrame, keys: Sequence[str] = ("symbol",), order: str = "date",
                  fresh: bool = False) -> DataFrame:
    """Ensure ``_idx``/``_n`` (contiguous per key, counting the rows of ``df``) exist.

    Reuses them when present (``fresh=False``); a subset of rows (e.g. the
    training rows) is renumbered from its block layout, or indexed anew.
    """
    if not fresh and halo.IDX in df.columns and halo.CNT in df.columns:
        return df
    if halo.BLK in df.columns:
        return halo.reindex(df, keys, order)
    return halo.index_rows(df.drop(*[c for c in (halo.IDX, halo.CNT) if c in df.columns]), keys, order)


def chrono_split(df: DataFrame, frac: float = 0.8, keys: Sequence[str] = ("symbol",), order: str = "date",
                 col: str = "split") -> DataFrame:
    """Add ``split`` = 'train' for the first ``floor(frac * n)`` rows of each key, else 'test'."""
    p = with_position(df, keys, order)
    cut = F.floor(F.lit(float(frac)) * F.col(halo.CNT))
    return p.withColumn(col, F.when(F.col(halo.IDX) < cut, F.lit("train")).otherwise(F.lit("test")))


def except_all_split(df: DataFrame, train: DataFrame) -> DataFrame:
    """Reference-parity test set: all rows EXCEPT ALL the training rows (keeps duplicates)."""
    return df.exceptAll(train)


def subtract_split(df: DataFrame, train: DataFrame) -> DataFrame:
    """Reference-parity test set with EXCEPT DISTINCT semantics (drops duplicate rows)."""
    return df.subtract(train)


def time_folds(df: DataFrame, k: int = 3, keys=("symbol",), order: str = "date", col: str = "fold") -> DataFrame:
    """Contiguous time blocks per key: ``fold = floor(_idx * k / _n)`` (int)."""
    p = with_position(df, keys, order, fresh=True)
    return p.withColumn(col, F.floor(F.col(halo.IDX) * F.lit(k) / F.col(halo.CNT)).cast("int"))
