"""Queries: streaming bars, indicators, alerts, scoring and dedup (run with availableNow)."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.operators import indicators as ind, regress as rg
from barflow.plans.q_features import ADJ, ORD
from barflow.plans.q_ml import _train_test
from barflow.plans.q_model import SPLIT_CTE
from barflow.plans.registry import frame, part, r4, register, rounded
from barflow.session import materialize, scratch_path
from barflow.sources import bars as src
from barflow.sources.schema import FEATURE_COLS
from barflow.streaming import stream as st

WATERMARK = "10 minutes"
ALERT_PCT = 50.0


#: Files of a feed, each a micro-batch of its own.
FEED_FILES = 4


#: Bars of a feed in order come at most this much out of order, and the watermark waits as long.
OUT_OF_ORDER_DAYS = 30


def _near_order_feed(spark, df, name: str) -> str:
    """As ``_feed``, but files in order of time: a bar moves back by up to ``OUT_OF_ORDER_DAYS`` (by hash), rows of a file lie in no order."""
    path = scratch_path(spark, f"{name}-feed")
    arrival = F.datediff("date", F.lit("1970-01-01")) + F.pmod(F.xxhash64(*df.columns), F.lit(OUT_OF_ORDER_DAYS))
    df = materialize(df.withColumn("_at", arrival), name)
    low, high = df.agg(F.min("_at"), F.max("_at")).first()
    width = ((high or 0) - (low or 0)) // FEED_FILES + 1
    for k in range(FEED_FILES):  # one write after another: the file source reads by time of change
        df.where(F.floor((F.col("_at") - F.lit(low)) / width) == k).drop("_at").repartition(1).write.mode("append").parquet(path)
    return path


def _feed(spark, df, name: str) -> str:
    """Write a table as the file feed a stream reads (shared folder): rows in no order, dealt over the files by hash."""
    path = scratch_path(spark, f"{name}-feed")
    df.repartition(FEED_FILES, F.xxhash64(*df.columns)).write.mode("overwrite").parquet(path)
    return path


@register(
    "stream_bars",
    sql=f"""WITH e AS ({src.EVT_BARS_SQL}), mx AS (SELECT max(ts) AS max_ts FROM events)
SELECT symbol, bar_ts, {r4("open", "open")}, {r4("high", "high")}, {r4("low", "low")}, {r4("close", "close")}, volume
FROM e, mx WHERE bar_ts + INTERVAL 1 HOUR <= max_ts - INTERVAL {WATERMARK}""",
    ops="T1 T5 (event-time windows, watermark, append mode: closed bars)",
)
def q_stream_bars(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    ticks = spark.readStream.schema(ev.schema).parquet(f"{sf}/events.parquet*")  # a glob, so that the file source lists the folder; no other name begins so
    bars = st.tick_bars(ticks.select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price")),
                        "symbol", "ts", "price", "1 hour", WATERMARK)
    return rounded(st.run_to_table(spark, bars, "stream-bars", "append"))


def _adj_feed(spark, sf):
    bars = ind.use_adjusted_close(src.ord_bars(spark, sf))
    path = _feed(spark, bars, "ord-bars")
    return st.bar_stream(spark, path, bars.schema, max_files_per_trigger=1)


INDICATORS_SQL = f"""WITH {ORD}, {ADJ},
l AS (SELECT symbol, date, close, high, low, lag(close) OVER ({part()}) AS prev FROM b),
d AS (SELECT *, close - prev AS diff, avg(close) {frame(10)} AS ma_10, avg(close) {frame(50)} AS ma_50,
        avg(close) {frame(20)} AS ma_20, stddev_samp(close) {frame(20)} AS sd_20,
        avg(low) {frame(14)} AS ll, avg(high) {frame(14)} AS hh FROM l),
g AS (SELECT *, avg(CASE WHEN diff > 0 THEN diff ELSE 0 END) {frame(14)} AS ag,
        avg(CASE WHEN diff < 0 THEN -diff ELSE 0 END) {frame(14)} AS al FROM d)
SELECT symbol, date, {r4("close", "close")}, {r4("prev", "prev_close")},
       {r4("(close - prev) / nullif(prev, 0) * 100.0", "change_pct")}, {r4("ma_10", "ma_10")}, {r4("ma_50", "ma_50")},
       {r4("100 - 100 / (1 + ag / nullif(al, 0))", "rsi")}, {r4("ma_20 + 2 * sd_20", "upper_bb")},
       {r4("ma_20 - 2 * sd_20", "lower_bb")}, {r4("100 * (close - ll) / nullif(hh - ll, 0)", "stoch_osc")} FROM g"""


def _live_feed(spark, sf):
    bars = ind.use_adjusted_close(src.ord_bars(spark, sf))
    path = _near_order_feed(spark, bars, "ord-bars")
    st.close_feed(spark, path, bars.schema, OUT_OF_ORDER_DAYS)
    return st.bar_stream(spark, path, bars.schema, max_files_per_trigger=1)


@register("stream_indicators", sql=INDICATORS_SQL, ops="T3 (W1-W8 from keyed state, bars up to 30 days out of order)")
def q_stream_indicators(spark, sf):
    return rounded(st.run_to_table(spark, st.live_indicators(_live_feed(spark, sf), f"{OUT_OF_ORDER_DAYS} days", "3650 days"), "stream-ind"))


@register("stream_indicators_any_order", sql=INDICATORS_SQL, ops="T3 (W1-W8, bars late by any time correct their rows; one file per micro-batch)")
def q_stream_indicators_any_order(spark, sf):
    return rounded(st.run_live(spark, _adj_feed(spark, sf), "stream-ind"))


ALERTS_SQL = f"""WITH {ORD}, {ADJ},
l AS (SELECT symbol, date, close, lag(close) OVER ({part()}) AS prev FROM b),
c AS (SELECT *, (close - prev) / nullif(prev, 0) * 100.0 AS change_pct FROM l)
SELECT symbol, date, {r4("close", "close")}, {r4("prev", "prev_close")}, {r4("change_pct", "change_pct")}
FROM c WHERE abs(change_pct) >= {ALERT_PCT}"""


@register("stream_alerts", sql=ALERTS_SQL, ops="T4 (keyed state: the last bar of each symbol)")
def q_stream_alerts(spark, sf):
    alerts = st.price_alerts(st.live_changes(_live_feed(spark, sf), f"{OUT_OF_ORDER_DAYS} days"), ALERT_PCT)
    return rounded(st.run_to_table(spark, alerts, "stream-alerts"))


@register("stream_alerts_any_order", sql=ALERTS_SQL, ops="T4 (bars late by any time)")
def q_stream_alerts_any_order(spark, sf):
    return rounded(st.price_alerts(st.run_live(spark, _adj_feed(spark, sf), "stream-alerts", st.change_rows, depth=1), ALERT_PCT))


@register(
    "stream_dedupe",
    sql=f"WITH t AS ({src.NUL_ROWS_SQL}) SELECT DISTINCT symbol, date FROM t",
    ops="T6 (distinct bar keys of an unordered stream, one file per micro-batch)",
)
def q_stream_dedupe(spark, sf):
    rows = src.nul_rows(spark, sf)
    s = st.bar_stream(spark, _feed(spark, rows, "nul-rows"), rows.schema, max_files_per_trigger=1)
    return st.run_distinct(spark, s, "stream-dedupe").select("symbol", "date")


@register(
    "stream_dedupe_watermark",
    sql=f"WITH t AS ({src.NUL_ROWS_SQL}) SELECT DISTINCT symbol, date FROM t",
    ops="T6 (first row of every bar key within the watermark, state expires with it)",
)
def q_stream_dedupe_watermark(spark, sf):
    rows = src.nul_rows(spark, sf)
    s = st.bar_stream(spark, _near_order_feed(spark, rows, "nul-rows"), rows.schema, max_files_per_trigger=1)
    return st.run_to_table(spark, st.dedupe_stream(s, delay=f"{OUT_OF_ORDER_DAYS} days"), "stream-dedupe").select("symbol", "date")


@register(
    "stream_score",
    sql=f"WITH {SPLIT_CTE} SELECT symbol, date, CAST(0 AS DOUBLE) AS difference FROM sp WHERE split = 'test'",
    ops="T2 (fitted pipeline applied to a feature stream: the difference from batch scoring)",
)
def q_stream_score(spark, sf):
    train, test = _train_test(spark, sf)
    pipe, _ = rg.lr_pipeline(FEATURE_COLS, "target", regParam=0.01, elasticNetParam=0.0)
    model = pipe.fit(train)
    rows = test.select("symbol", "date", *FEATURE_COLS, "target")
    s = st.bar_stream(spark, _feed(spark, rows, "feature-rows"), rows.schema, max_files_per_trigger=1)
    scored = st.run_to_table(spark, st.score_stream(model, s), "stream-score", "append")
    own = rg.predictions(model, test).select("symbol", "date", F.col("prediction").alias("own"))
    return rounded(scored.join(own, ["symbol", "date"]).select("symbol", "date", F.abs(F.col("prediction") - F.col("own")).alias("difference")))
