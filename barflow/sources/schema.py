"""Typed schemas for bar tables and derived tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("adj_close", T.DoubleType(), True),
        T.StructField("volume", T.LongType(), True),
    ]
)

# Daily-bar CSV as published by the usual price sites (one symbol per file).
CSV_BAR_SCHEMA = T.StructType(
    [
        T.StructField("Date", T.DateType(), True),
        T.StructField("Open", T.DoubleType(), True),
        T.StructField("High", T.DoubleType(), True),
        T.StructField("Low", T.DoubleType(), True),
        T.StructField("Close", T.DoubleType(), True),
        T.StructField("Adj Close", T.DoubleType(), True),
        T.StructField("Volume", T.LongType(), True),
    ]
)

CSV_RENAMES = {
    "Date": "date",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}

# The regression feature list of the reference notebook, in its
# order (snake_case names; close is the label side).
FEATURE_COLS = [
    "open",
    "high",
    "low",
    "volume",
    "price_range",
    "daily_change",
    "ma_10",
    "ma_50",
    "rsi",
    "upper_bb",
    "lower_bb",
    "stoch_osc",
]

def feature_columns(df: DataFrame, exclude: Sequence[str] = ("symbol", "date", "close"), numeric_only: bool = True) -> list[str]:
    """Every column except keys and label (the dynamic feature selection variant)."""
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields
            if f.name not in exclude and not f.name.startswith("_") and (not numeric_only or isinstance(f.dataType, num))]


PREDICTION_SCHEMA = "symbol string, date date, label double, prediction double, model string, split string"
SEQUENCE_SCHEMA = "symbol string, date date, x array<double>, y double"
FORECAST_SCHEMA = "symbol string, step int, date date, forecast double"


def profile_schema(df: DataFrame) -> DataFrame:
    """Schema report as a DataFrame ``column, type, nullable, position``."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean, position int")
