"""Structured Streaming: bars from ticks, live indicators, alerts, scoring, dedup.

* ``tick_bars``: event-time tumbling windows with a watermark; append mode
  emits a bar once the watermark passes its end, so state holds only open
  windows.
* ``live_indicators`` / ``live_changes``: a streaming DataFrame of indicators (or
  changes) from keyed state: a ring of a symbol's last bars, the bars that the
  watermark has not passed yet, a timer and expiry (``live.py``). Any trigger and
  sink; nothing that was stored is read again.
* ``run_live``: indicators (or any row-frame rows) of a bar stream by
  ``foreachBatch`` over the blocked batch windows; bars late by any time correct
  the rows they change. Its cost grows with the stored history.
* ``price_alerts``: rows filtered to |change| >= threshold.
* ``score_stream``: a fitted ``PipelineModel`` applied to a stream (stateless).
* ``run_distinct``: distinct keys of any feed; ``dedupe_stream``: within a
  watermark, for ordered feeds.

``run_to_table`` drives a query with ``availableNow`` into a Parquet sink in
the shared checkpoint folder and returns the sink as a batch DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow import ensure_importable
from barflow.operators import halo
from barflow.operators import indicators as ind
from barflow.session import scratch_path
from barflow.streaming import live


def bar_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = None) -> DataFrame:
    """T1: a file stream of bars (or ticks) with a fixed schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def close_feed(spark: SparkSession, path: str, schema: T.StructType, delay_days: int, order: str = "date") -> None:
    """The end of a feed folder: a row a day further ahead of the last bar than the delay, its other columns NULL.

    It lets the watermark pass every bar before it and is never passed itself, so
    keyed state gives the last ``delay_days`` out too and nothing for the row.
    """
    last = spark.read.schema(schema).parquet(path).agg(F.date_add(F.max(order), delay_days + 1).alias(order))
    row = [F.col(order).cast(f.dataType) if f.name == order else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    last.select(*row).write.mode("append").parquet(path)


def tick_bars(ticks: DataFrame, symbol: str = "symbol", ts: str = "ts", price: str = "price",
              interval: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """T5: OHLCV bars per symbol and event-time window, late ticks dropped.

    Append mode emits a bar once the watermark (max event time - ``delay``)
    passes its end. Spark drops a tick older than the watermark in force at the
    previous micro-batch; state holds only open windows.
    """
    t = ticks.withColumn(ts, F.col(ts).cast("timestamp"))  # watermarks need TIMESTAMP, not NTZ
    t = t.withWatermark(ts, delay)
    bars = t.groupBy(F.col(symbol).alias("symbol"), F.window(ts, interval)).agg(
        F.min_by(price, ts).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, ts).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
    return bars.select("symbol", F.col("window.start").cast("timestamp_ntz").alias("bar_ts"),
                       "open", "high", "low", "close", "volume")


def indicator_rows(indexed: DataFrame) -> DataFrame:
    """MA10/MA50, RSI14, Bollinger(20, 2), stochastic(14, mean form) and change, by the batch windows (NULLs as there)."""
    keys = ["symbol"]
    h = halo.blocked(indexed, keys, "date", preceding=49)
    s = ind._Spec(keys)
    h = h.withColumns({"prev_close": s.lag("close", 1), "ma_10": s.sma("close", 10), "ma_50": s.sma("close", 50),
                       "_ma_20": s.sma("close", 20), "_std": s.std("close", 20), "_ll": s.sma("low", 14), "_hh": s.sma("high", 14)})
    h = ind._rsi_parts(h, s, "close", 14)
    h = h.withColumns({
        "change_pct": F.try_divide(F.col("close") - F.col("prev_close"), F.col("prev_close")) * F.lit(100.0),
        "rsi": ind.rsi_expr(), "stoch_osc": ind.stoch_expr("close", "_ll", "_hh"),
        "upper_bb": F.col("_ma_20") + F.lit(2.0) * F.col("_std"), "lower_bb": F.col("_ma_20") - F.lit(2.0) * F.col("_std"),
    })
    return halo.core(h).select("symbol", "date", "close", "prev_close", "change_pct", "ma_10", "ma_50", "rsi", "upper_bb",
                               "lower_bb", "stoch_osc", halo.IDX)


def change_rows(indexed: DataFrame) -> DataFrame:
    """The change against the previous close: all that an alert needs."""
    h = halo.blocked(indexed, ["symbol"], "date", preceding=1)
    h = h.withColumn("prev_close", ind._Spec(["symbol"]).lag("close", 1))
    change = F.try_divide(F.col("close") - F.col("prev_close"), F.col("prev_close")) * F.lit(100.0)
    return halo.core(h).select("symbol", "date", "close", "prev_close", change.alias("change_pct"), halo.IDX)


def _newest(rows: DataFrame, keys: Sequence[str], *ties: str) -> DataFrame:
    """The row of the latest batch for each key; within a batch the one with the largest ``ties``."""
    w = Window.partitionBy(*keys).orderBy(F.col("batch").desc(), *[F.col(c).desc_nulls_last() for c in ties])
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def _apply_batch(batch: DataFrame, number: int, root: str, rows, depth: int, block: float | None) -> None:
    """Store a micro-batch of bars and compute again every row whose frame it touches."""
    spark = batch.sparkSession
    bars = batch.select("symbol", "date", *[F.col(c).cast("double") for c in ("close", "high", "low")])
    bars = bars.withColumn("_tb", halo.bucket(bars, "date", block))
    bars.write.mode("overwrite").parquet(f"{root}/bars/batch={number}")  # the same batch again writes the same files
    stored = spark.read.schema(bars.schema.add("batch", "long")).option("basePath", f"{root}/bars").parquet(f"{root}/bars").where(F.col("batch") <= number)
    touched = stored.where(F.col("batch") == number).select("symbol", "_tb").distinct()
    symbols = touched.select(F.col("symbol").alias("_sym")).distinct()
    own = stored.join(symbols, F.col("symbol").eqNullSafe(F.col("_sym")), "left_semi")
    latest = _newest(own, ["symbol", "date"], "close", "high", "low")
    # rows of each symbol and time bucket: where a bucket's positions begin
    counts = latest.groupBy("symbol", "_tb").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("symbol")
    counts = counts.select("symbol", "_tb", "_c", (F.sum("_c").over(w.orderBy("_tb")) - F.col("_c")).alias("_from"), F.sum("_c").over(w).alias(halo.CNT))
    spans = halo.join_null_safe(counts, touched, ["symbol", "_tb"]).select(F.col("symbol").alias("_sym"), F.col("_from").alias("_lo"), (F.col("_from") + F.col("_c") + depth).alias("_hi"))
    near = F.col("symbol").eqNullSafe(F.col("_sym")) & (F.col("_from") < F.col("_hi")) & (F.col("_from") + F.col("_c") > F.col("_lo") - depth)
    needed = counts.join(spans, near, "left_semi")
    placed = halo.join_null_safe(latest, needed, ["symbol", "_tb"])
    local = F.row_number().over(Window.partitionBy("symbol", "_tb").orderBy("date")) - 1
    placed = placed.withColumn(halo.IDX, F.col("_from") + local).select("symbol", "date", "close", "high", "low", halo.IDX, halo.CNT)
    inside = F.col("symbol").eqNullSafe(F.col("_sym")) & (F.col(halo.IDX) >= F.col("_lo")) & (F.col(halo.IDX) < F.col("_hi"))
    rows(placed).join(spans, inside, "left_semi").drop(halo.IDX).write.mode("overwrite").parquet(f"{root}/rows/batch={number}")


def run_live(spark: SparkSession, bars: DataFrame, name: str, rows=indicator_rows, depth: int = 49, block: float | None = None) -> DataFrame:
    """T3: indicators of a bar stream, the same for any batching; the newest row of each (symbol, date).

    Every micro-batch is appended to a bar table (``foreachBatch``, idempotent by
    batch number). The time buckets it touches are then computed again by the
    blocked batch windows, with ``depth`` rows before them and for ``depth`` rows
    after them, so a late or corrected bar mends the rows that it changes. A
    repeated bar counts once: the one of the latest batch, then the largest
    close. No per-symbol state is kept, and a hot symbol is split by blocks.
    """
    root = scratch_path(spark, f"{name}-live")
    ensure_importable(spark)
    _finish(bars.writeStream.foreachBatch(lambda b, i: _apply_batch(b, i, root, rows, depth, block))
            .option("checkpointLocation", scratch_path(spark, f"{name}-ckpt")).trigger(availableNow=True).start())
    return _newest(spark.read.option("basePath", f"{root}/rows").parquet(f"{root}/rows"), ["symbol", "date"]).drop("batch")


def live_indicators(bars: DataFrame, delay: str, idle: str | None = None, order: str = "date") -> DataFrame:
    """T3: indicators of a bar stream from keyed state, as a streaming DataFrame (append mode).

    The columns of ``indicator_rows`` for each bar, once the watermark (largest
    ``order`` seen less ``delay``) has passed it. Bars may come in any order
    within the delay; a bar repeated before that counts once (the largest close),
    one later than the watermark is left out. A symbol without a bar for ``idle``
    of event time is forgotten: its next bar starts a new series.
    """
    return live.rows(bars, live.indicators, live.INDICATORS, 49, delay, idle, order)


def live_changes(bars: DataFrame, delay: str, idle: str | None = None, order: str = "date") -> DataFrame:
    """T4: the change against the previous close from keyed state (one bar a symbol); feeds ``price_alerts``."""
    return live.rows(bars, live.changes, live.CHANGES, 1, delay, idle, order)


def price_alerts(changes: DataFrame, threshold_pct: float = 50.0) -> DataFrame:
    """T4: bars whose close moved at least ``threshold_pct`` % against the previous close."""
    return changes.where(F.abs(F.col("change_pct")) >= F.lit(threshold_pct)).select("symbol", "date", "close", "prev_close", "change_pct")


def run_distinct(spark: SparkSession, rows: DataFrame, name: str, keys: Sequence[str] = ("symbol", "date"), order: str = "date") -> DataFrame:
    """T6: the first row of every key over the whole stream, however it is cut into batches.

    New keys of a batch are those not yet stored in its time buckets; the store
    on disk is the state. It is partitioned by batch and time bucket, so a batch
    reads the keys of the buckets that it spans and no others, however long the
    stream has run. Within a batch any one row of a key is kept.
    """
    root, keys = scratch_path(spark, f"{name}-distinct"), list(keys)
    _finish(rows.writeStream.foreachBatch(lambda batch, number: _store_new(batch, number, root, keys, order))
            .option("checkpointLocation", scratch_path(spark, f"{name}-ckpt")).trigger(availableNow=True).start())
    return spark.read.schema(_store_schema(rows, order)).parquet(root).select(*rows.columns)


def _store_schema(rows: DataFrame, order: str) -> T.StructType:
    return T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType()), T.StructField("_tb", T.LongType())])


def stored_keys(spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], number: int, low: int | None, high: int | None) -> DataFrame:
    """Keys of earlier batches in the time buckets from ``low`` to ``high`` and without a time: both are partition filters."""
    inside = F.col("_tb").isNull() if low is None else F.col("_tb").isNull() | F.col("_tb").between(low, high)
    kept = spark.read.schema(schema).option("basePath", root).parquet(root).where((F.col("batch") < number) & inside)
    return kept.select(*[F.col(c).alias(f"_k_{c}") for c in [*keys, "_tb"]])


def _store_new(batch: DataFrame, number: int, root: str, keys: list[str], order: str) -> None:
    """The step of ``run_distinct``: rows of new keys, below their batch and time bucket."""
    spark = batch.sparkSession
    new = batch.dropDuplicates(keys).withColumn("_tb", halo.bucket(batch, order))
    if number:
        span = new.agg(F.min("_tb"), F.max("_tb")).first()  # two numbers
        kept = stored_keys(spark, root, _store_schema(batch, order), keys, number, span[0], span[1])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in [*keys, "_tb"]])
        new = new.join(kept, same, "left_anti")
    new.write.mode("overwrite").partitionBy("_tb").parquet(f"{root}/batch={number}")


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def score_stream(model, rows: DataFrame, keys: Sequence[str] = ("symbol", "date"), label: str = "target") -> DataFrame:
    """T2: stateless scoring of pre-featured rows with a fitted pipeline."""
    return model.transform(rows).select(*keys, F.col(label).alias("label"), "prediction")


def dedupe_stream(rows: DataFrame, keys: Sequence[str] = ("symbol", "date"), event_time: str = "date",
                  delay: str = "1 day") -> DataFrame:
    """T6, for feeds ordered to within ``delay``: repeated keys go, and so do rows later than the watermark.

    State holds the keys of the delay only. ``run_distinct`` keeps every row of
    an unordered feed.
    """
    t = rows.withColumn("_et", F.col(event_time).cast("timestamp")).withWatermark("_et", delay)
    return t.dropDuplicatesWithinWatermark(list(keys)).drop("_et")


def run_to_table(spark: SparkSession, stream_df: DataFrame, name: str, output_mode: str = "append") -> DataFrame:
    """Run a streaming query to completion (``availableNow``) into Parquet; read it back."""
    sink = scratch_path(spark, f"{name}-sink")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = (
        stream_df.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", ckpt)
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    _finish(q)
    return spark.read.schema(stream_df.schema).parquet(sink)
