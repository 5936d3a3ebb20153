"""Malformed CSV lines, the bucketed sink, rules counted in passing."""

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from barflow.operators import quality
from barflow.session import scratch_path
from barflow.sources import io

HEADER = "Date,Open,High,Low,Close,Adj Close,Volume"
LINES = [
    "2020-01-01,1,2,0.5,1.5,1.5,100",
    "2020-01-02, 1 ,2,0.5,1.5,,",  # blanks and empty values are no fault
    "02/01/2020,1,2,0.5,1.5,1.5,100",
    "2020-02-30,1,2,0.5,1.5,1.5,100",
    "2020-01-03,1,2,low,1.5,1.5,100",
    "2020-01-04,1,2,0.5,1.5,1.5,100.5",
    "2020-01-05,1,2",
    "2020-01-06,1,2,0.5,1.5,1.5,100,7",
]


def test_malformed_lines_go_to_quarantine(spark, tmp_path):
    (tmp_path / "bars.csv").write_text("\n".join([HEADER, *LINES]) + "\n")
    good, bad = io.split_checked(io.read_bars_csv_checked(spark, str(tmp_path), "A"))
    assert sorted((str(r.date), r.open, r.adj_close, r.volume) for r in good.collect()) == [("2020-01-01", 1.0, 1.5, 100), ("2020-01-02", 1.0, None, None)]
    found = sorted((r.line, r.reason) for r in bad.collect())
    assert found == sorted(zip(LINES[2:], ["date", "date", "low", "volume", "columns", "columns"], strict=True)) and good.columns == io.read_bars_csv(spark, str(tmp_path), "A").columns


def test_bucketed_table_saves_an_exchange(spark):
    bars = spark.range(2000).select((F.col("id") % 7).cast("string").alias("symbol"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("close"))
    name = f"t_bars_{uuid.uuid4().hex[:8]}"
    table = io.write_bucketed(bars, name, scratch_path(spark, "t-bucketed"), 4)
    try:
        w = Window.partitionBy("symbol").orderBy("date")
        change = lambda df: df.withColumn("change", F.col("close") - F.lag("close").over(w))
        plans = [change(df)._jdf.queryExecution().executedPlan().toString() for df in (bars, table)]
        assert [p.count("Exchange hashpartitioning") for p in plans] == [1, 0]
        assert sorted(change(table).collect()) == sorted(change(bars).collect())
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_rules_counted_in_passing(spark):
    rows = [("A", 1, 5.0, 4.0, 4.5, 1), ("A", 2, 3.0, 4.0, -1.0, -5), ("B", 3, None, None, None, None)]
    df = spark.createDataFrame(rows, "symbol string, date int, high double, low double, close double, volume long")
    out, seen = quality.observed_rules(df)
    out.write.parquet(scratch_path(spark, "t-observed"))
    per_key = quality.quality_rules(df)
    total = per_key.agg(*[F.sum(c).alias(c) for c in seen.get]).first().asDict()
    assert seen.get == total and total["n_rows"] == 3 and total["high_below_low"] == 1 and total["null_close"] == 1
