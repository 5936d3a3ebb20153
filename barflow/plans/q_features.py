"""Queries: adjusted close, derived prices, indicators, target, halo windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from barflow.operators import halo, indicators as ind
from barflow.plans.registry import frame, part, r4, register, rounded
from barflow.session import materialize
from barflow.sources import bars as src

ORD = f"bars AS ({src.ORD_BARS_SQL})"


def ord_adj(spark, sf):
    """F-ORD bars with the adjusted close, ingested once as a table."""
    return materialize(ind.use_adjusted_close(src.ord_bars(spark, sf)), "ord-adj")


def lin(spark, sf):
    """F-LIN bars ingested once as a table."""
    return materialize(src.lin_bars(spark, sf), "lin-bars")

ADJ = "b AS (SELECT symbol, date, open, high, low, adj_close AS close, volume FROM bars)"
LIN = f"b AS ({src.LIN_BARS_SQL})"


@register(
    "adj_close_mismatch",
    sql=f"""WITH {ORD}
SELECT symbol, date, {r4("close", "close")}, {r4("adj_close", "adj_close")}
FROM bars WHERE close <> adj_close""",
    ops="P4",
)
def q_adj_close_mismatch(spark, sf):
    return rounded(ind.adj_close_mismatch(src.ord_bars(spark, sf)))


@register(
    "use_adjusted_close",
    sql=f"""WITH {ORD}, {ADJ}
SELECT symbol, date, {r4("open", "open")}, {r4("high", "high")}, {r4("low", "low")},
       {r4("close", "close")}, volume FROM b""",
    ops="P3",
)
def q_use_adjusted_close(spark, sf):
    return rounded(ind.use_adjusted_close(src.ord_bars(spark, sf)))


@register(
    "use_adjusted_ohl",
    sql=f"""WITH {ORD}
SELECT symbol, date, {r4("open * (adj_close / nullif(close, 0))", "open")}, {r4("high * (adj_close / nullif(close, 0))", "high")},
       {r4("low * (adj_close / nullif(close, 0))", "low")}, {r4("adj_close", "close")}, volume FROM bars""",
    ops="P3 Q2 (open, high and low by the factor of the close)",
)
def q_use_adjusted_ohl(spark, sf):
    return rounded(ind.use_adjusted_close(src.ord_bars(spark, sf), adjust_ohl=True))


@register(
    "price_range_change",
    sql=f"""WITH {ORD}, {ADJ}
SELECT symbol, date, {r4("high - low", "price_range")}, {r4("close - open", "daily_change")} FROM b""",
    ops="P8",
)
def q_price_range_change(spark, sf):
    b = ind.use_adjusted_close(src.ord_bars(spark, sf))
    return rounded(ind.price_range_change(b).select("symbol", "date", "price_range", "daily_change"))


@register(
    "sma_10_50",
    sql=f"""WITH {LIN}
SELECT symbol, date, {r4(f"avg(close) {frame(10)}", "ma_10")}, {r4(f"avg(close) {frame(50)}", "ma_50")} FROM b""",
    ops="W1 W2",
)
def q_sma_10_50(spark, sf):
    out = ind.moving_averages(lin(spark, sf), (10, 50))
    return rounded(out.select("symbol", "date", "ma_10", "ma_50"))


_RSI_SQL = f"""WITH {ORD}, {ADJ},
d AS (SELECT symbol, date, close - lag(close) OVER ({part()}) AS diff FROM b),
g AS (SELECT symbol, date,
        avg(CASE WHEN diff > 0 THEN diff ELSE 0 END) {frame(14)} AS ag,
        avg(CASE WHEN diff < 0 THEN -diff ELSE 0 END) {frame(14)} AS al FROM d)
SELECT symbol, date, {r4("100 - 100 / (1 + ag / nullif(al, 0))", "rsi")} FROM g"""


@register("rsi_14", sql=_RSI_SQL, ops="W3 W4 W5 W6")
def q_rsi_14(spark, sf):
    return rounded(ind.rsi(ord_adj(spark, sf), 14).select("symbol", "date", "rsi"))


@register(
    "bollinger_20",
    sql=f"""WITH {LIN},
s AS (SELECT symbol, date, avg(close) {frame(20)} AS m, stddev_samp(close) {frame(20)} AS sd FROM b)
SELECT symbol, date, {r4("m", "ma_20")}, {r4("sd", "std_20")}, {r4("m + 2 * sd", "upper_bb")},
       {r4("m - 2 * sd", "lower_bb")} FROM s""",
    ops="W7",
)
def q_bollinger_20(spark, sf):
    out = ind.bollinger(lin(spark, sf), 20, 2.0)
    return rounded(out.select("symbol", "date", "ma_20", "std_20", "upper_bb", "lower_bb"))


def _stoch_sql(lo: str, hi: str) -> str:
    return f"""WITH {ORD}, {ADJ},
s AS (SELECT symbol, date, close, {lo}(low) {frame(14)} AS ll, {hi}(high) {frame(14)} AS hh FROM b)
SELECT symbol, date, {r4("ll", "lowest_low")}, {r4("hh", "highest_high")},
       {r4("100 * (close - ll) / nullif(hh - ll, 0)", "stoch_osc")} FROM s"""


@register("stoch_mean_14", sql=_stoch_sql("avg", "avg"), ops="W8 (mean, parity)")
def q_stoch_mean_14(spark, sf):
    return rounded(ind.stochastic(ord_adj(spark, sf), 14, "mean").select("symbol", "date", "lowest_low", "highest_high", "stoch_osc"))


@register("stoch_minmax_14", sql=_stoch_sql("min", "max"), ops="W8 (min/max, textbook)")
def q_stoch_minmax_14(spark, sf):
    return rounded(ind.stochastic(ord_adj(spark, sf), 14, "minmax").select("symbol", "date", "lowest_low", "highest_high", "stoch_osc"))


def features_sql(with_target: bool = False, bars_cte: str = ORD, adj_cte: str = ADJ, order: str = "date") -> str:
    """SQL twin of ``technical_features`` (unrounded CTE chain ending in ``feat``)."""

    def fr(n):
        return frame(n, order=order)

    p = part(order=order)
    target = f", lead(close) OVER ({p}) AS target" if with_target else ""
    tcond = " AND target IS NOT NULL" if with_target else ""
    return f"""{bars_cte}, {adj_cte},
f1 AS (SELECT *, high - low AS price_range, close - open AS daily_change,
         avg(close) {fr(10)} AS ma_10, avg(close) {fr(50)} AS ma_50,
         close - lag(close) OVER ({p}) AS diff,
         avg(close) {fr(20)} AS ma_20, stddev_samp(close) {fr(20)} AS sd_20,
         avg(low) {fr(14)} AS ll, avg(high) {fr(14)} AS hh{target} FROM b),
f2 AS (SELECT *, avg(CASE WHEN diff > 0 THEN diff ELSE 0 END) {fr(14)} AS ag,
         avg(CASE WHEN diff < 0 THEN -diff ELSE 0 END) {fr(14)} AS al FROM f1),
f3 AS (SELECT symbol, {order}, open, high, low, close, volume, price_range, daily_change, ma_10, ma_50,
         100 - 100 / (1 + ag / nullif(al, 0)) AS rsi, ma_20 + 2 * sd_20 AS upper_bb, ma_20 - 2 * sd_20 AS lower_bb,
         100 * (close - ll) / nullif(hh - ll, 0) AS stoch_osc{", target" if with_target else ""} FROM f2),
feat AS (SELECT * FROM f3 WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
         AND volume IS NOT NULL AND rsi IS NOT NULL AND upper_bb IS NOT NULL AND lower_bb IS NOT NULL
         AND stoch_osc IS NOT NULL AND ma_10 IS NOT NULL AND ma_50 IS NOT NULL{tcond})"""


FEATURE_SELECT = ", ".join(
    [
        "symbol",
        "date",
        *[r4(c, c) for c in ("open", "high", "low", "close")],
        "volume",
        *[r4(c, c) for c in ind.FEATURE_OUT],
    ]
)


@register("technical_features", sql=f"WITH {features_sql()} SELECT {FEATURE_SELECT} FROM feat", ops="W14 W13 P8 W1-W8")
def q_technical_features(spark, sf):
    return rounded(halo.drop_helpers(ind.technical_features(ord_adj(spark, sf))))


@register(
    "next_close_target",
    sql=f"WITH {features_sql(True)} SELECT {FEATURE_SELECT}, {r4('target', 'target')} FROM feat",
    ops="W9",
)
def q_next_close_target(spark, sf):
    return rounded(halo.drop_helpers(ind.technical_features(ord_adj(spark, sf), with_target=True)))


@register(
    "technical_features_lin",
    sql=f"""WITH {features_sql(False, f"bars AS ({src.LIN_BARS_SQL})",
        "b AS (SELECT symbol, date, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close) AS open, "
        "high, low, close, volume FROM bars)")} SELECT {FEATURE_SELECT} FROM feat""",
    ops="W14 on the wide panel",
)
def q_technical_features_lin(spark, sf):
    return rounded(halo.drop_helpers(ind.technical_features(lin(spark, sf), adjusted=False, open_from_close=True)))


@register(
    "halo_sma_50",
    sql=f"""WITH {ORD}, {ADJ}
SELECT symbol, date, {r4(f"avg(close) {frame(50)}", "ma_50")}, {r4(f"close - lag(close) OVER ({part()})", "diff_1")}
FROM b""",
    ops="halo-blocked window with small blocks (every series crosses many block edges)",
)
def q_halo_sma_50(spark, sf):
    b = ord_adj(spark, sf)
    h = halo.blocked(b, ["symbol"], "date", preceding=49, block=40, block_rows=64)
    w = halo.block_window(["symbol"])
    h = h.withColumns(
        {"ma_50": F.avg("close").over(w.rowsBetween(-49, 0)), "diff_1": F.col("close") - F.lag("close", 1).over(w)}
    )
    return rounded(halo.core(h).select("symbol", "date", "ma_50", "diff_1"))


EVT = f"bars AS ({src.EVT_BARS_SQL})"
EVT_B = "b AS (SELECT symbol, bar_ts, open, high, low, close, volume FROM bars)"


@register(
    "technical_features_hourly",
    sql=f"""WITH {features_sql(False, EVT, EVT_B, order="bar_ts")}
SELECT {FEATURE_SELECT.replace("symbol, date,", "symbol, bar_ts,")} FROM feat""",
    ops="W14 on hourly bars (timestamp order column, F-EVT)",
)
def q_technical_features_hourly(spark, sf):
    b = materialize(src.evt_bars(spark, sf), "evt-bars")
    return rounded(halo.drop_helpers(ind.technical_features(b, order="bar_ts", adjusted=False)))
