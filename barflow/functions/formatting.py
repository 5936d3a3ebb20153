"""Display formatting of KPI columns (output only; keep numbers numeric upstream)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money(col: str | Column, symbol: str = "$", decimals: int = 2) -> Column:
    """``$1,234.56``; negative values as ``-$1,234.56``."""
    c = _c(col)
    body = F.format_number(F.abs(c), decimals)
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.concat(F.when(c < 0, F.lit("-")).otherwise(F.lit("")), F.lit(symbol), body)
    )


def thousands(col: str | Column, decimals: int = 0) -> Column:
    """``12,345,678`` (grouped digits)."""
    return F.format_number(_c(col), decimals)


def percent(col: str | Column, decimals: int = 2, signed: bool = True) -> Column:
    """``+1.23%`` from a value already in percent."""
    c = _c(col)
    fmt = f"%{'+' if signed else ''}.{decimals}f%%"
    return F.format_string(fmt, c)
