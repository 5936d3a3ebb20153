"""Queries: CSV sink/scan round trip, filtered export, schema report."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barflow.operators import quality
from barflow.plans.q_explore import KPI_END, KPI_START
from barflow.plans.q_features import ORD
from barflow.plans.registry import r4, register, rounded
from barflow.session import scratch_path
from barflow.sources import bars as src
from barflow.sources import io
from barflow.sources.schema import BAR_SCHEMA, profile_schema

_BAR_SELECT = ", ".join(
    ["symbol", "date", *[r4(c, c) for c in ("open", "high", "low", "close", "adj_close")], "volume"]
)


@register("csv_roundtrip", sql=f"WITH {ORD} SELECT {_BAR_SELECT} FROM bars", ops="S5 S1 S2 (CSV sink, typed CSV scan)")
def q_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "bars-csv")
    io.write_bars_csv(src.ord_bars(spark, sf), path)
    return rounded(io.read_bars_csv_partitioned(spark, path))


@register(
    "export_range_csv",
    sql=f"WITH {ORD} SELECT {_BAR_SELECT} FROM bars WHERE date BETWEEN DATE '{KPI_START}' AND DATE '{KPI_END}'",
    ops="S6 P5 P6",
)
def q_export_range_csv(spark, sf):
    path = scratch_path(spark, "export")
    io.export_range(src.ord_bars(spark, sf), path, KPI_START, KPI_END, fmt="csv")
    return rounded(spark.read.schema(BAR_SCHEMA).option("header", True).csv(path))


@register(
    "csv_quarantine",
    sql=f"""WITH {ORD} SELECT symbol, CASE day(date) WHEN 5 THEN 'date' WHEN 11 THEN 'high' WHEN 17 THEN 'columns' WHEN 23 THEN 'columns' WHEN 29 THEN 'volume'
  ELSE 'good' END AS reason, count(*) AS n, {r4("sum(CASE WHEN day(date) NOT IN (5, 11, 17, 23, 29) THEN close END)", "good_close")} FROM bars GROUP BY 1, 2""",
    ops="S1 (malformed lines: good rows and a quarantine with the reason)",
)
def q_csv_quarantine(spark, sf):
    path, day = scratch_path(spark, "bars-broken"), F.dayofmonth("date")
    text = [F.col(c).cast("string") for c in ("date", "open", "high", "low", "close", "adj_close", "volume")]
    broken = [F.when(day == 5, F.concat(F.lit("x"), text[0])).otherwise(text[0]), text[1], F.when(day == 11, F.lit("abc")).otherwise(text[2]),
              *text[3:6], F.when(day == 29, F.lit("1.5e")).otherwise(text[6])]
    line = F.when(day == 17, F.concat_ws(",", *text[:4])).when(day == 23, F.concat_ws(",", *text, F.lit("more"))).otherwise(F.concat_ws(",", *broken))
    src.ord_bars(spark, sf).select("symbol", line.alias("value")).write.partitionBy("symbol").text(path)
    good, bad = io.split_checked(io.read_bars_csv_checked(spark, path, header=False))
    counts = good.groupBy("symbol").agg(F.lit("good").alias("reason"), F.count(F.lit(1)).alias("n"), F.sum("close").alias("good_close"))
    return rounded(counts.unionByName(bad.groupBy("symbol", "reason").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("good_close"))))


@register("bucketed_roundtrip", sql=f"WITH {ORD} SELECT {_BAR_SELECT} FROM bars", ops="S5 (bucketed by symbol, sorted by date)")
def q_bucketed_roundtrip(spark, sf):
    return rounded(io.write_bucketed(src.ord_bars(spark, sf), f"barflow_bars_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bars-bucketed"), 8))


@register(
    "quality_observed",
    sql=f"""WITH {ORD} SELECT count(*) AS n_rows, count(*) FILTER (WHERE close IS NULL) AS null_close, count(*) FILTER (WHERE volume IS NULL) AS null_volume,
  count(*) FILTER (WHERE volume < 0) AS negative_volume, count(*) FILTER (WHERE high < low) AS high_below_low,
  count(*) FILTER (WHERE close > high OR close < low) AS close_outside_range, count(*) FILTER (WHERE close <= 0) AS non_positive_close FROM bars""",
    ops="D2 (counted while the bars are written, no scan of its own)",
)
def q_quality_observed(spark, sf):
    bars, seen = quality.observed_rules(src.ord_bars(spark, sf))
    io.write_table(bars, scratch_path(spark, "bars-observed"))
    return spark.createDataFrame([tuple(seen.get.values())], ", ".join(f"{c} long" for c in seen.get))


@register("schema_report", ops="S4 (column, type, nullable of the bar table)")
def q_schema_report(spark, sf):
    bars = src.ord_bars(spark, sf)
    n = bars.count()
    return profile_schema(bars).withColumn("n_rows", F.lit(n))
