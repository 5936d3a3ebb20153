"""Readers and writers for bar tables.

CSV is read with an explicit schema (inference gives ``Date`` as date or string
depending on the parser policy, and costs an extra pass), then normalised to
``BAR_SCHEMA`` names. Writers never go through the driver; CSV output is sorted
by key within files and partitioned by symbol, Parquet is the default format.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.functions import dates
from barflow.operators.explore import date_range
from barflow.sources.schema import CSV_BAR_SCHEMA, CSV_RENAMES


def read_bars_csv(spark: SparkSession, path: str, symbol: str | None = None, mode: str = "PERMISSIVE") -> DataFrame:
    """Daily-bar CSV(s) with the usual ``Date,Open,High,Low,Close,Adj Close,Volume`` header.

    A ``symbol=...`` partition folder supplies the symbol; otherwise pass ``symbol``.
    """
    df = spark.read.schema(CSV_BAR_SCHEMA).option("header", True).option("mode", mode).csv(path)
    df = df.select(*[F.col(f"`{k}`").alias(v) for k, v in CSV_RENAMES.items()], *[
        c for c in df.columns if c not in CSV_RENAMES
    ])
    if symbol is not None:
        df = df.withColumn("symbol", F.lit(symbol))
    return df.select("symbol", "date", "open", "high", "low", "close", "adj_close", "volume")


def read_bars_csv_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read a ``symbol=...`` partitioned CSV folder written by ``write_bars_csv``."""
    schema = T.StructType([*CSV_BAR_SCHEMA.fields, T.StructField("symbol", T.StringType(), True)])
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select(*[F.col(f"`{k}`").alias(v) for k, v in CSV_RENAMES.items()], "symbol").select(
        "symbol", "date", "open", "high", "low", "close", "adj_close", "volume"
    )


CORRUPT, REASON = "_corrupt", "reason"


def read_bars_csv_checked(spark: SparkSession, path: str, symbol: str | None = None, header: bool = True) -> DataFrame:
    """As ``read_bars_csv`` with ``symbol`` folders or a given one, and two more columns: the raw line and what is wrong with it.

    Each line is read once as text columns and once typed by expressions, so the
    reason names the column: ``columns`` (too few or too many), else the first
    column whose text is not a date or number. A good row has NULL in both.
    """
    names = [f.name for f in CSV_BAR_SCHEMA.fields]
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(CORRUPT, T.StringType())])
    if symbol is None:
        schema = schema.add("symbol", "string")  # the folder's
    raw = spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    wrong = F.when(F.col(CORRUPT).isNotNull(), F.lit("columns"))
    typed = []
    for f in CSV_BAR_SCHEMA.fields:
        text, value = F.col(f"`{f.name}`"), F.trim(f"`{f.name}`").try_cast(f.dataType)
        if isinstance(f.dataType, T.DateType):
            value = dates.parse_date(F.trim(text), "yyyy-MM-dd")
        wrong = wrong.when(text.isNotNull() & (F.trim(text) != "") & value.isNull(), F.lit(CSV_RENAMES[f.name]))
        typed.append(value.alias(CSV_RENAMES[f.name]))
    line = F.coalesce(CORRUPT, F.concat_ws(",", *[F.coalesce(f"`{n}`", F.lit("")) for n in names]))
    out = raw.select(F.lit(symbol).alias("symbol") if symbol is not None else "symbol", *typed, wrong.alias(REASON), F.when(wrong.isNotNull(), line).alias(CORRUPT))
    return out.select("symbol", "date", "open", "high", "low", "close", "adj_close", "volume", REASON, CORRUPT)


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good bars, and the quarantine: ``symbol, reason, line``."""
    good = checked.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)
    return good, checked.where(F.col(REASON).isNotNull()).select("symbol", REASON, F.col(CORRUPT).alias("line"))


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "symbol", order: str = "date", mode: str = "overwrite") -> DataFrame:
    """S5: a Parquet table bucketed by ``key`` and sorted by ``order``; windows, joins and aggregates by ``key`` read it without an exchange.

    The table's files lie below ``path``. Rows are dealt by the bucket before they
    are written, so there is one file for each bucket.
    """
    dealt = df.repartition(buckets, key).write.mode(mode).format("parquet").option("path", path)
    dealt.bucketBy(buckets, key).sortBy(key, order).saveAsTable(table)
    return df.sparkSession.table(table)


def write_bars_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with the reference header names, one folder per symbol, rows date-sorted in each file.

    Range partitioning on (symbol, Date) cuts a large symbol into several
    date-contiguous files written by different tasks.
    """
    inv = {v: k for k, v in CSV_RENAMES.items()}
    out = df.select("symbol", *[F.col(c).alias(inv[c]) for c in CSV_RENAMES.values()])
    (
        out.repartitionByRange("symbol", "Date")
        .sortWithinPartitions("symbol", "Date")
        .write.mode(mode)
        .option("header", True)
        .partitionBy("symbol")
        .csv(path)
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def export_range(df: DataFrame, path: str, start=None, end=None, order: str = "date", fmt: str = "csv") -> None:
    """Filter to ``start <= order <= end`` (pushed to the scan) and write."""
    write_table(date_range(df, start, end, order), path, fmt)
