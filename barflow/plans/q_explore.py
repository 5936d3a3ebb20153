"""Queries: profile, NULLs, quality rules, date ranges, KPIs, correlation, box plots."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from barflow.functions import dates
from barflow.operators import explore as ex, indicators as ind, quality as qa
from barflow.plans.registry import r4, register, rounded
from barflow.sources import bars as src

ORD = f"bars AS ({src.ORD_BARS_SQL})"
ADJ = "b AS (SELECT symbol, date, open, high, low, adj_close AS close, volume FROM bars)"
NUL = f"t AS ({src.NUL_ROWS_SQL})"
DESC_COLS = ["open", "high", "low", "close", "adj_close", "volume"]
KPI_START, KPI_END = "1994-01-01", "1996-12-31"


def _describe_sql() -> str:
    parts = []
    for c in DESC_COLS:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, {r4(f'avg({x})', 'mean')}, "
            f"{r4(f'stddev_samp({x})', 'stddev')}, {r4(f'min({x})', 'min')}, {r4(f'max({x})', 'max')} FROM bars"
        )
    return f"WITH {ORD} " + " UNION ALL ".join(parts)


@register("profile_describe", sql=_describe_sql(), ops="A2 S4")
def q_profile_describe(spark, sf):
    d = qa.describe(src.ord_bars(spark, sf), DESC_COLS).withColumnRenamed("column", "column_name")
    return rounded(d)


@register(
    "profile_shape",
    sql=f"WITH {ORD} SELECT count(*) AS n_rows, 8 AS n_cols FROM bars",
    ops="S4 A1",
)
def q_profile_shape(spark, sf):
    return qa.shape(src.ord_bars(spark, sf)).withColumn("n_cols", F.col("n_cols").cast("int"))


@register(
    "null_counts",
    sql=f"WITH {NUL} SELECT "
    + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ["symbol", "seq", "date", "close", "volume"])
    + " FROM t",
    ops="A3",
)
def q_null_counts(spark, sf):
    return qa.null_counts(src.nul_rows(spark, sf))


def _quality_sql(cte: str, table: str, bars: bool) -> str:
    extra = (
        ", count(*) FILTER (WHERE high < low) AS high_below_low,"
        " count(*) FILTER (WHERE close > high OR close < low) AS close_outside_range"
        if bars
        else ""
    )
    return f"""WITH {cte},
r AS (SELECT symbol, count(*) AS n_rows, count(*) FILTER (WHERE close IS NULL) AS null_close,
        count(*) FILTER (WHERE volume IS NULL) AS null_volume, count(*) FILTER (WHERE volume < 0) AS negative_volume{extra},
        count(*) FILTER (WHERE close <= 0) AS non_positive_close FROM {table} GROUP BY symbol),
k AS (SELECT symbol, date, count(*) AS c FROM {table} GROUP BY symbol, date),
d AS (SELECT symbol, CAST(sum(c - 1) AS BIGINT) AS dup_key_rows, count(*) AS n_distinct_dates FROM k GROUP BY symbol)
SELECT * FROM r JOIN d USING (symbol)"""


@register("quality_rules", sql=_quality_sql(NUL, "t", False), ops="D2 (row grain, duplicates)")
def q_quality_rules(spark, sf):
    return qa.quality_rules(src.nul_rows(spark, sf))


@register("quality_rules_bars", sql=_quality_sql(ORD, "bars", True), ops="D2 (bars)")
def q_quality_rules_bars(spark, sf):
    return qa.quality_rules(src.ord_bars(spark, sf))


@register(
    "dropna_bars",
    sql=f"""WITH {NUL} SELECT symbol, seq, date, {r4("close", "close")}, volume FROM t
WHERE symbol IS NOT NULL AND seq IS NOT NULL AND date IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL""",
    ops="P7",
)
def q_dropna_bars(spark, sf):
    return rounded(qa.drop_nulls(src.nul_rows(spark, sf)))


@register(
    "dedupe_sum_by_date",
    sql=f"WITH {NUL} SELECT symbol, date, {r4('sum(close)', 'sum_close')}, count(*) AS n_rows FROM t GROUP BY symbol, date",
    ops="A4",
)
def q_dedupe_sum_by_date(spark, sf):
    return rounded(qa.sum_by_key(src.nul_rows(spark, sf)))


def _kpi_sql(where: str) -> str:
    return f"""WITH {ORD}, {ADJ},
k AS (SELECT symbol, avg(close) AS mean_close, max(high) AS max_high, min(low) AS min_low, count(*) AS n_bars,
        min_by(close, date) AS first_close, max_by(close, date) AS last_close FROM b {where} GROUP BY symbol)
SELECT symbol, {r4("mean_close", "mean_close")}, {r4("max_high", "max_high")}, {r4("min_low", "min_low")}, n_bars,
       {r4("first_close", "first_close")}, {r4("last_close", "last_close")},
       {r4("(last_close - first_close) * 100.0 / nullif(first_close, 0)", "change_pct")} FROM k"""


@register(
    "date_range_kpis",
    sql=_kpi_sql(f"WHERE date >= DATE '{KPI_START}' AND date <= DATE '{KPI_END}'"),
    ops="P5 A5 A6 (filtered)",
)
def q_date_range_kpis(spark, sf):
    b = ind.use_adjusted_close(src.ord_bars(spark, sf))
    return rounded(ex.price_summary(b, KPI_START, KPI_END))


@register("period_change_pct", sql=_kpi_sql(""), ops="A5 A6")
def q_period_change_pct(spark, sf):
    return rounded(ex.price_kpis(ind.use_adjusted_close(src.ord_bars(spark, sf))))


@register(
    "date_bounds",
    sql=f"WITH {ORD} SELECT symbol, min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY symbol",
    ops="A7",
)
def q_date_bounds(spark, sf):
    return ex.date_bounds(src.ord_bars(spark, sf))


def _corr_sql() -> str:
    parts = [
        f"SELECT symbol, '{a}' AS col_a, '{b}' AS col_b, {r4(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 'corr')}"
        " FROM bars GROUP BY symbol"
        for a, b in itertools.combinations(DESC_COLS, 2)
    ]
    return f"WITH {ORD} " + " UNION ALL ".join(parts)


@register("corr_matrix", sql=_corr_sql(), ops="A9")
def q_corr_matrix(spark, sf):
    return rounded(ex.corr_matrix(src.ord_bars(spark, sf), DESC_COLS))


_BOX_CTE = f"""{ORD}, {ADJ},
y AS (SELECT symbol, CAST(year(date) AS INTEGER) AS year, date, close FROM b),
q AS (SELECT symbol, year, quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.5) AS median,
        quantile_cont(close, 0.75) AS q3 FROM y GROUP BY symbol, year),
j AS (SELECT y.*, q1, median, q3, q3 - q1 AS iqr,
        close >= q1 - 1.5 * (q3 - q1) AND close <= q3 + 1.5 * (q3 - q1) AS inside FROM y JOIN q USING (symbol, year))"""


@register(
    "boxplot_by_year",
    sql=f"""WITH {_BOX_CTE}
SELECT symbol, year, {r4("q1", "q1")}, {r4("median", "median")}, {r4("q3", "q3")}, {r4("iqr", "iqr")},
       {r4("min(close) FILTER (WHERE inside)", "whisker_low")}, {r4("max(close) FILTER (WHERE inside)", "whisker_high")},
       count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n
FROM j GROUP BY symbol, year, q1, median, q3, iqr""",
    ops="A10",
)
def q_boxplot_by_year(spark, sf):
    return rounded(ex.box_stats(ind.use_adjusted_close(src.ord_bars(spark, sf))))


@register(
    "boxplot_outliers",
    sql=f"WITH {_BOX_CTE} SELECT symbol, date, year, {r4('close', 'close')} FROM j WHERE NOT inside",
    ops="A10 (outlier rows)",
)
def q_boxplot_outliers(spark, sf):
    return rounded(ex.box_outliers(ind.use_adjusted_close(src.ord_bars(spark, sf))))


@register(
    "downsample_monthly",
    sql=f"""WITH {ORD}, {ADJ}
SELECT symbol, CAST(date_trunc('month', date) AS DATE) AS period, {r4("max_by(close, date)", "last_close")},
       {r4("avg(close)", "mean_close")} FROM b GROUP BY symbol, date_trunc('month', date)""",
    ops="A11",
)
def q_downsample_monthly(spark, sf):
    return rounded(ex.downsample(ind.use_adjusted_close(src.ord_bars(spark, sf)), "month"))


@register(
    "first_rows_per_symbol",
    sql=f"""WITH {ORD}, {ADJ},
r AS (SELECT symbol, date, close, row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM b)
SELECT symbol, date, {r4("close", "close")} FROM r WHERE rn <= 5""",
    ops="O2 O3 (first n in order, per symbol)",
)
def q_first_rows(spark, sf):
    b = ind.use_adjusted_close(src.ord_bars(spark, sf)).select("symbol", "date", "close")
    return rounded(ex.first_rows(b, 5))


def _kpi_report_sql() -> str:
    money = lambda c: f"CASE WHEN {c} < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', abs({c}))"
    numbers = _kpi_sql(f"WHERE date >= DATE '{KPI_START}' AND date <= DATE '{KPI_END}'")
    return f"""SELECT symbol, {", ".join(f"{money(c)} AS {c}" for c in ("mean_close", "max_high", "min_low"))},
  format('{{:,}}', n_bars) AS n_bars, printf('%+.2f%%', change_pct) AS change_pct FROM ({numbers})"""


@register("kpi_report", sql=_kpi_report_sql(), ops="F11 A5 A6 (formatted dashboard KPIs)")
def q_kpi_report(spark, sf):
    from barflow.functions.formatting import money, percent, thousands

    k = rounded(ex.price_summary(ind.use_adjusted_close(src.ord_bars(spark, sf)), KPI_START, KPI_END))  # decimal ties print alike in both engines
    return k.select(
        "symbol",
        money("mean_close").alias("mean_close"),
        money("max_high").alias("max_high"),
        money("min_low").alias("min_low"),
        thousands("n_bars").alias("n_bars"),
        percent("change_pct").alias("change_pct"),
    )


_BOX_LIN_CTE = f"""b AS ({src.LIN_BARS_SQL}),
y AS (SELECT symbol, CAST(year(date) AS INTEGER) AS year, date, close FROM b),
q AS (SELECT symbol, year, quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.5) AS median,
        quantile_cont(close, 0.75) AS q3 FROM y GROUP BY symbol, year),
j AS (SELECT y.*, q1, median, q3, q3 - q1 AS iqr,
        close >= q1 - 1.5 * (q3 - q1) AND close <= q3 + 1.5 * (q3 - q1) AS inside FROM y JOIN q USING (symbol, year))"""


@register(
    "boxplot_by_year_lin",
    sql=f"""WITH {_BOX_LIN_CTE}
SELECT symbol, year, {r4("q1", "q1")}, {r4("median", "median")}, {r4("q3", "q3")}, {r4("iqr", "iqr")},
       {r4("min(close) FILTER (WHERE inside)", "whisker_low")}, {r4("max(close) FILTER (WHERE inside)", "whisker_high")},
       count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n
FROM j GROUP BY symbol, year, q1, median, q3, iqr""",
    ops="A10 on the wide panel (1,000 series at sf0.1)",
)
def q_boxplot_by_year_lin(spark, sf):
    return rounded(ex.box_stats(src.lin_bars(spark, sf)))


@register(
    "boxplot_outliers_lin",
    sql=f"WITH {_BOX_LIN_CTE} SELECT symbol, date, year, {r4('close', 'close')} FROM j WHERE NOT inside",
    ops="A10 outlier rows on the wide panel",
)
def q_boxplot_outliers_lin(spark, sf):
    return rounded(ex.box_outliers(src.lin_bars(spark, sf)))


@register(
    "boxplot_one_group",
    sql=f"""WITH b AS ({src.LIN_BARS_SQL}),
q AS (SELECT quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.5) AS median, quantile_cont(close, 0.75) AS q3 FROM b),
j AS (SELECT b.close, q1, median, q3, q3 - q1 AS iqr, close >= q1 - 1.5 * (q3 - q1) AND close <= q3 + 1.5 * (q3 - q1) AS inside FROM b CROSS JOIN q)
SELECT {r4("q1", "q1")}, {r4("median", "median")}, {r4("q3", "q3")}, {r4("iqr", "iqr")},
       {r4("min(close) FILTER (WHERE inside)", "whisker_low")}, {r4("max(close) FILTER (WHERE inside)", "whisker_high")},
       count(*) FILTER (WHERE NOT inside) AS n_outliers, count(*) AS n FROM j GROUP BY q1, median, q3, iqr""",
    ops="A10 (one group of all rows, exact quartiles by histogram refinement)",
)
def q_boxplot_one_group(spark, sf):
    return rounded(ex.box_stats(src.lin_bars(spark, sf), keys=(), by="all", bound=ex.selection.BOUND).drop("all"))


WIDE_COLS = 30


def _wide_sql(i: int) -> str:
    """Column ``i`` of the wide table, the same text in both engines: a mix of two prices with its own gaps."""
    mix = f"CAST(l_quantity AS DOUBLE) * {i} + CAST(l_extendedprice AS DOUBLE) / 1000 * {WIDE_COLS - i} + (l_partkey * {i + 1}) % 97"
    return f"CASE WHEN l_orderkey % {i + 11} <> 0 THEN {mix} END AS x{i}"


_WIDE_PAIRS = list(itertools.combinations(range(WIDE_COLS), 2))


@register(
    "corr_wide",
    sql=f"""WITH w AS (SELECT {", ".join(map(_wide_sql, range(WIDE_COLS)))} FROM lineitem),
c AS (SELECT [{", ".join(f"corr(x{a}, x{b})" for a, b in _WIDE_PAIRS)}] AS r FROM w),
n AS (SELECT unnest([{", ".join(f"'x{a}'" for a, _ in _WIDE_PAIRS)}]) AS col_a, unnest([{", ".join(f"'x{b}'" for _, b in _WIDE_PAIRS)}]) AS col_b, unnest(r) AS corr FROM c)
SELECT col_a, col_b, {r4("corr", "corr")} FROM n""",
    ops="A9 (wide data: one matrix of sums a task)",
)
def q_corr_wide(spark, sf):
    items = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(*map(_wide_sql, range(WIDE_COLS)))
    return rounded(ex.corr_wide(items, items.columns))


@register(
    "parse_dates",
    sql="""SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS iso, CAST(o_orderdate AS DATE) AS parsed,
       CAST(NULL AS DATE) AS malformed FROM orders""",
    ops="F1 F2 F3 (ISO text, parsing with a pattern, malformed text to NULL)",
)
def q_parse_dates(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", dates.iso_date("o_orderdate").alias("iso"))
    broken = dates.parse_date(F.concat(F.lit("x"), F.col("iso")))
    return o.select("o_orderkey", "iso", dates.parse_date("iso", "yyyy-MM-dd").alias("parsed"), broken.alias("malformed"))


@register(
    "date_range_hours",
    sql=f"""WITH e AS ({src.EVT_BARS_SQL})
SELECT symbol, bar_ts, volume FROM e WHERE CAST(bar_ts AS DATE) BETWEEN DATE '2024-01-09' AND DATE '2024-01-10'""",
    ops="P5 (calendar days on a timestamp series)",
)
def q_date_range_hours(spark, sf):
    bars = src.evt_bars(spark, sf)
    return ex.date_range(bars, "2024-01-09", "2024-01-10", "bar_ts").select("symbol", "bar_ts", "volume")


@register(
    "quality_null_keys",
    sql=f"""WITH t AS (SELECT CASE WHEN seq % 50 = 0 THEN NULL ELSE symbol END AS symbol, date, close FROM ({src.NUL_ROWS_SQL})),
k AS (SELECT symbol, date, count(*) AS c FROM t GROUP BY symbol, date),
d AS (SELECT symbol, CAST(sum(c - 1) AS BIGINT) AS dup_key_rows, count(*) AS n_distinct_dates FROM k GROUP BY symbol),
r AS (SELECT symbol, count(*) AS n_rows, count(*) FILTER (WHERE close IS NULL) AS null_close FROM t GROUP BY symbol)
SELECT r.symbol, n_rows, null_close, dup_key_rows, n_distinct_dates FROM r JOIN d ON r.symbol IS NOT DISTINCT FROM d.symbol""",
    ops="D2 (rows with a NULL key are reported)",
)
def q_quality_null_keys(spark, sf):
    rows = src.nul_rows(spark, sf)
    rows = rows.withColumn("symbol", F.when(F.col("seq") % 50 != 0, F.col("symbol")))
    return qa.quality_rules(rows.select("symbol", "date", "close")).select("symbol", "n_rows", "null_close", "dup_key_rows", "n_distinct_dates")


@register(
    "sma_5000",
    sql=f"""SELECT event_type AS symbol, ts, {r4("avg(value) OVER (PARTITION BY event_type ORDER BY ts ROWS BETWEEN 4999 PRECEDING AND CURRENT ROW)", "ma_5000")}
FROM events""",
    ops="W1 (a frame deeper than a block, at tick grain)",
)
def q_sma_5000(spark, sf):
    ticks = spark.read.parquet(f"{sf}/events.parquet").select(F.col("event_type").alias("symbol"), "ts", "value")
    return rounded(ind.moving_averages(ticks, (5000,), "value", order="ts", block=86400).select("symbol", "ts", "ma_5000"))  # places counted a day at a time
