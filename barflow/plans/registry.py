"""Named queries: a Spark builder plus (where SQL can say it) a DuckDB oracle.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame (queries that
write intermediate tables run those jobs while they are built). Doubles are
rounded to 4 decimals on both sides so that summation order cannot decide a
comparison; every computed column is aliased to the same name in both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass
class Query:
    name: str
    fn: QueryFn
    sql: str | None
    ops: str


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ops: str = ""):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, fn, sql, ops)
        return fn

    return deco


def round4(c) -> "F.Column":
    """Output rounding to 4 decimals, shared with the oracle SQL (``r4``); the operators return full precision.

    Engines add up doubles in different orders, so a mean of prices that is a
    decimal tie (1.23455) comes out a last bit above or below it. Both sides
    therefore go through an exact decimal with 7 places, where the tie is a tie.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.try_cast("decimal(38,7)"), 4).cast("double")


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double/float column (output side only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round4(F.col(f.name).cast("double")).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def part(symbol_cols: str = "symbol", order: str = "date") -> str:
    return f"PARTITION BY {symbol_cols} ORDER BY {order}"


def frame(n: int, symbol_cols: str = "symbol", order: str = "date") -> str:
    """SQL ``OVER (...)`` clause for an n-row trailing frame."""
    return f"OVER ({part(symbol_cols, order)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def r4(expr: str, alias: str) -> str:
    """SQL twin of ``round4``."""
    return f"CAST(round(CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38,7)), 4) AS DOUBLE) AS {alias}"
