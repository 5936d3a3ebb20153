"""Bar tables built from raw rows.

``bars_from_ticks`` is the generic operator (ticks -> OHLCV bars, the batch twin
of the streaming bar builder). The ``*_bars`` adapters derive the test fixtures
from the driver tables; all of them are hash aggregates with partial (map-side)
aggregation, so a hot symbol is pre-reduced before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ohlcv_aggs(price: str | Column, seq: str | Column, volume: Column | None = None) -> list[Column]:
    """open/high/low/close of ``price`` ordered by ``seq`` plus a volume."""
    p = F.col(price) if isinstance(price, str) else price
    s = F.col(seq) if isinstance(seq, str) else seq
    return [
        F.min_by(p, s).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, s).alias("close"),
        (volume if volume is not None else F.count(F.lit(1))).alias("volume"),
    ]


def bars_from_ticks(
    ticks: DataFrame,
    symbol: str = "symbol",
    ts: str = "ts",
    price: str = "price",
    unit: str = "hour",
    bar_col: str = "bar_ts",
) -> DataFrame:
    """Tumbling OHLCV bars: ``date_trunc(unit, ts)`` per symbol.

    The bar timestamp keeps the input's timestamp flavour (NTZ stays NTZ).
    """
    ts_type = ticks.schema[ts].dataType.simpleString()
    bucket = F.date_trunc(unit, F.col(ts)).cast(ts_type)
    return ticks.groupBy(F.col(symbol).alias("symbol"), bucket.alias(bar_col)).agg(*ohlcv_aggs(price, ts))


def ord_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-ORD: daily OHLCV for 5 symbols (order priorities) from ``orders``.

    ``adj_close`` halves closes before 1998-01-01 to mimic a 2:1 split.
    """
    o = read_table(spark, sf_dir, "orders")
    date = F.col("o_orderdate").cast("date")
    bars = o.groupBy(F.col("o_orderpriority").alias("symbol"), date.alias("date")).agg(
        *ohlcv_aggs("o_totalprice", "o_orderkey")
    )
    factor = F.when(F.col("date") < F.lit("1998-01-01").cast("date"), F.lit(0.5)).otherwise(F.lit(1.0))
    return bars.select(
        "symbol", "date", "open", "high", "low", "close", (F.col("close") * factor).alias("adj_close"), "volume"
    )


def evt_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-EVT: hourly bars from the ``events`` tick table."""
    ev = read_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price")
    )
    return bars_from_ticks(ev, "symbol", "ts", "price", "hour")


def lin_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-LIN: one daily series per supplier from ``lineitem`` (no open)."""
    li = read_table(spark, sf_dir, "lineitem")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return li.groupBy(
        F.col("l_suppkey").cast("string").alias("symbol"), F.col("l_shipdate").cast("date").alias("date")
    ).agg(
        (F.sum("l_extendedprice") / F.sum("l_quantity")).alias("close"),
        F.max(unit).alias("high"),
        F.min(unit).alias("low"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )


def nul_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-NUL: row-grain prices with injected NULLs and duplicate dates."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_orderpriority").alias("symbol"),
        k.alias("seq"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(k % 97 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("close"),
        F.when(k % 89 == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("volume"),
    )


# DuckDB/ANSI twins of the adapters, used by the oracle SQL.
ORD_BARS_SQL = """
SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
       min_by(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
       max_by(o_totalprice, o_orderkey) AS close,
       max_by(o_totalprice, o_orderkey)
         * CASE WHEN CAST(o_orderdate AS DATE) < DATE '1998-01-01' THEN 0.5e0 ELSE 1.0e0 END AS adj_close,
       count(*) AS volume
FROM orders GROUP BY o_orderpriority, CAST(o_orderdate AS DATE)
"""

EVT_BARS_SQL = """
SELECT event_type AS symbol, date_trunc('hour', ts) AS bar_ts,
       min_by(value, ts) AS open, max(value) AS high, min(value) AS low, max_by(value, ts) AS close,
       count(*) AS volume
FROM events GROUP BY event_type, date_trunc('hour', ts)
"""

LIN_BARS_SQL = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
       sum(l_extendedprice) / sum(l_quantity) AS close,
       max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
       CAST(sum(l_quantity) AS BIGINT) AS volume
FROM lineitem GROUP BY l_suppkey, CAST(l_shipdate AS DATE)
"""

NUL_ROWS_SQL = """
SELECT o_orderpriority AS symbol, o_orderkey AS seq, CAST(o_orderdate AS DATE) AS date,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS close,
       CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END AS volume
FROM orders
"""
