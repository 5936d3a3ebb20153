"""Technical indicators over per-symbol ordered bars.

All indicators share one window spec on the halo-blocked layout, so a feature
build is planned as: one block exchange (indexing) + one exchange for the halo union + one sort +
a few Window nodes. Semantics follow the reference notebook:

* row frames ``ROWS BETWEEN n-1 PRECEDING AND CURRENT ROW``; warm-up frames are
  partial (row 1 of MA_50 is its own close), not NULL;
* RSI is the simple-average form ``100 - 100 / (1 + avg_gain / avg_loss)`` over
  14 rows, with the first row's missing difference counted as gain = loss = 0;
  a zero average loss gives NULL (``try_divide``) rather than an error;
* Bollinger bands use the sample standard deviation over 20 rows;
* the stochastic oscillator's "lowest low"/"highest high" are 14-row *averages*
  in ``mode="mean"`` (reference parity) or true min/max in ``mode="minmax"``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.operators import halo

FEATURE_OUT = ["price_range", "daily_change", "ma_10", "ma_50", "rsi", "upper_bb", "lower_bb", "stoch_osc"]


def use_adjusted_close(bars: DataFrame, adjust_ohl: bool = False) -> DataFrame:
    """Replace ``close`` by ``adj_close``.

    Open, high and low stay as they are, or with ``adjust_ohl`` are scaled by the
    same factor ``adj_close / close`` (NULL where the close is 0 or NULL).
    """
    if adjust_ohl:
        factor = F.try_divide(F.col("adj_close"), F.col("close"))
        bars = bars.withColumns({c: F.col(c) * factor for c in ("open", "high", "low")})
    return bars.drop("close").withColumnRenamed("adj_close", "close")


def adj_close_mismatch(bars: DataFrame, null_safe: bool = False) -> DataFrame:
    """Rows whose close differs from the adjusted close."""
    cond = ~F.col("close").eqNullSafe(F.col("adj_close")) if null_safe else F.col("close") != F.col("adj_close")
    return bars.where(cond).select("symbol", "date", "close", "adj_close")


def price_range_change(bars: DataFrame) -> DataFrame:
    """``price_range = high - low``, ``daily_change = close - open``."""
    return bars.withColumns(
        {"price_range": F.col("high") - F.col("low"), "daily_change": F.col("close") - F.col("open")}
    )


def _frame(w, n: int):
    return w.rowsBetween(-(n - 1), 0)


class _Spec:
    """Column builders bound to one block window."""

    def __init__(self, keys: Sequence[str]):
        self.w = halo.block_window(keys)

    def sma(self, col: str, n: int) -> Column:
        return F.avg(col).over(_frame(self.w, n))

    def std(self, col: str, n: int) -> Column:
        return F.stddev_samp(col).over(_frame(self.w, n))

    def lag(self, col: str, k: int = 1) -> Column:
        return F.lag(col, k).over(self.w)

    def lead(self, col: str, k: int = 1) -> Column:
        return F.lead(col, k).over(self.w)

    def fmin(self, col: str, n: int) -> Column:
        return F.min(col).over(_frame(self.w, n))

    def fmax(self, col: str, n: int) -> Column:
        return F.max(col).over(_frame(self.w, n))


def _rsi_parts(df: DataFrame, s: _Spec, close: str, n: int) -> DataFrame:
    diff = F.col(close) - s.lag(close, 1)
    df = df.withColumn("_diff", diff)
    df = df.withColumns(
        {
            "_gain": F.when(F.col("_diff") > 0, F.col("_diff")).otherwise(F.lit(0.0)),
            "_loss": F.when(F.col("_diff") < 0, -F.col("_diff")).otherwise(F.lit(0.0)),
        }
    )
    return df.withColumns({"_avg_gain": s.sma("_gain", n), "_avg_loss": s.sma("_loss", n)})


def rsi_expr(avg_gain: str = "_avg_gain", avg_loss: str = "_avg_loss", zero_loss: str = "null") -> Column:
    rs = F.try_divide(F.col(avg_gain), F.col(avg_loss))
    out = F.lit(100.0) - F.try_divide(F.lit(100.0), F.lit(1.0) + rs)
    if zero_loss == "100":
        out = F.when(F.col(avg_loss) == 0, F.lit(100.0)).otherwise(out)
    return out


def stoch_expr(close: str, lo: str, hi: str) -> Column:
    return F.try_divide(F.lit(100.0) * (F.col(close) - F.col(lo)), F.col(hi) - F.col(lo))


def technical_features(
    bars: DataFrame,
    keys: Sequence[str] = ("symbol",),
    order: str = "date",
    adjusted: bool = True,
    stoch_mode: str = "mean",
    with_target: bool = False,
    drop_nulls: bool = True,
    block: float | None = None,
    open_from_close: bool = False,
) -> DataFrame:
    """Bars + price_range, daily_change, MA10/50, RSI14, Bollinger(20,2), stochastic(14).

    ``open_from_close`` derives ``open = coalesce(previous close, close)`` inside
    the same window pass, for bar tables that have no open.

    With ``with_target`` the next bar's close is added as ``target`` (the last
    bar of each symbol has none and is dropped with the NULL rows).
    Output keeps ``_blk`` so later steps can ``halo.reindex`` the surviving rows.
    """
    keys = list(keys)
    df = use_adjusted_close(bars) if adjusted and "adj_close" in bars.columns else bars
    carry = [c for c in (halo.IDX, halo.CNT) if c in df.columns]  # reuse a contiguous index if present
    df = df.select(*keys, order, *[c for c in ("open", "high", "low", "close", "volume") if c in df.columns], *carry)
    h = halo.blocked(df, keys, order, preceding=49, following=1 if with_target else 0, block=block)
    s = _Spec(keys)
    if open_from_close:
        h = h.withColumn("open", F.coalesce(s.lag("close", 1), F.col("close")))
    h = price_range_change(h)
    h = h.withColumns({"ma_10": s.sma("close", 10), "ma_50": s.sma("close", 50)})
    h = _rsi_parts(h, s, "close", 14)
    h = h.withColumns({"_ma_20": s.sma("close", 20), "_std": s.std("close", 20)})
    if stoch_mode == "mean":
        lo, hi = s.sma("low", 14), s.sma("high", 14)
    elif stoch_mode == "minmax":
        lo, hi = s.fmin("low", 14), s.fmax("high", 14)
    else:
        raise ValueError(stoch_mode)
    h = h.withColumns({"_ll": lo, "_hh": hi})
    cols = {
        "rsi": rsi_expr(),
        "upper_bb": F.col("_ma_20") + F.lit(2.0) * F.col("_std"),
        "lower_bb": F.col("_ma_20") - F.lit(2.0) * F.col("_std"),
        "stoch_osc": stoch_expr("close", "_ll", "_hh"),
    }
    if with_target:
        cols["target"] = s.lead("close", 1)
    h = halo.core(h.withColumns(cols))
    base_cols = [c for c in ("open", "high", "low", "close", "volume") if c in df.columns or c == "open" and open_from_close]
    out_cols = [*keys, order, *base_cols]
    out_cols += FEATURE_OUT + (["target"] if with_target else [])
    out = h.select(*out_cols, halo.IDX, halo.CNT, halo.BLK)
    if drop_nulls:
        # NULL rows can sit anywhere: positions are no longer contiguous, keep only the block
        out = out.na.drop("any", subset=out_cols).drop(halo.IDX, halo.CNT)
    return out


#: Frames of more rows are added up from whole parts: Spark reads every row of a sliding frame again for each row.
DEEP_FRAME = 256


def _deep_average(df: DataFrame, keys: Sequence[str], order: str, col: str, n: int, block: float | None) -> DataFrame:
    """``ma_<n>`` of a deep frame, in a few additions a row.

    With blocks of ``n`` rows, the frame of a row is its own block up to it and
    the end of the block before it. Both are running sums (the second one
    backwards), so nothing is subtracted: one value that is huge, infinite or NaN
    shows in its own frames only.
    """
    h = halo.blocked(df, keys, order, preceding=n - 1, block=block, block_rows=n)
    kind = df.select(F.avg(col).alias("a")).schema["a"].dataType
    exact = isinstance(df.schema[col].dataType, T.DecimalType)
    h = h.withColumn("_x", F.col(col) if exact else F.col(col).cast("double")).repartition(halo.BLK, *keys)  # the one exchange of all three windows
    parts = Window.partitionBy(halo.BLK, *keys, halo.HOME)
    ahead, back = (parts.orderBy(o).rowsBetween(Window.unboundedPreceding, 0) for o in (F.col(halo.IDX).desc(), F.col(halo.IDX)))
    h = h.withColumns({"_end_sum": F.sum("_x").over(ahead), "_end_count": F.count("_x").over(ahead)})
    h = h.withColumns({"_own_sum": F.sum("_x").over(back), "_own_count": F.count("_x").over(back)})
    first = F.col(halo.IDX) % n != n - 1  # the frame begins in the block before
    w = halo.block_window(keys)
    added = {c: F.coalesce(f"_own{c}", F.lit(0)) + F.when(first, F.coalesce(F.lag(f"_end{c}", n - 1).over(w), F.lit(0))).otherwise(F.lit(0)) for c in ("_sum", "_count")}
    h = halo.core(h.withColumns(added))
    h = h.withColumn(f"ma_{n}", F.try_divide("_sum", "_count").cast(kind))
    return h.drop("_x", *[f"{p}{c}" for p in ("_end", "_own", "") for c in ("_sum", "_count")])


def moving_averages(bars: DataFrame, windows: Sequence[int] = (10, 50), col: str = "close", keys=("symbol",),
                    order: str = "date", block: float | None = None) -> DataFrame:
    """``ma_<n>`` columns for each n (partial warm-up frames)."""
    keys = list(keys)
    flat, deep = [n for n in windows if n <= DEEP_FRAME], [n for n in windows if n > DEEP_FRAME]
    out = bars
    if flat:
        h = halo.blocked(bars, keys, order, preceding=max(flat) - 1, block=block)
        s = _Spec(keys)
        out = halo.core(h.withColumns({f"ma_{n}": s.sma(col, n) for n in flat}))
    for n in deep:
        out = _deep_average(out, keys, order, col, n, block)
    return halo.drop_helpers(out)


def rsi(bars: DataFrame, n: int = 14, col: str = "close", keys=("symbol",), order: str = "date",
        zero_loss: str = "null", block: float | None = None) -> DataFrame:
    """Simple-average RSI(n) as column ``rsi`` (NULL while average loss is 0)."""
    keys = list(keys)
    h = halo.blocked(bars, keys, order, preceding=n, block=block)
    h = _rsi_parts(h, _Spec(keys), col, n)
    h = h.withColumn("rsi", rsi_expr(zero_loss=zero_loss))
    return halo.drop_helpers(halo.core(h)).drop("_diff", "_gain", "_loss", "_avg_gain", "_avg_loss")


def bollinger(bars: DataFrame, n: int = 20, k: float = 2.0, col: str = "close", keys=("symbol",),
              order: str = "date", block: float | None = None) -> DataFrame:
    """``ma_<n>``, ``std_<n>``, ``upper_bb``, ``lower_bb``."""
    keys = list(keys)
    h = halo.blocked(bars, keys, order, preceding=n - 1, block=block)
    s = _Spec(keys)
    h = h.withColumns({f"ma_{n}": s.sma(col, n), f"std_{n}": s.std(col, n)})
    h = h.withColumns(
        {
            "upper_bb": F.col(f"ma_{n}") + F.lit(k) * F.col(f"std_{n}"),
            "lower_bb": F.col(f"ma_{n}") - F.lit(k) * F.col(f"std_{n}"),
        }
    )
    return halo.drop_helpers(halo.core(h))


def stochastic(bars: DataFrame, n: int = 14, mode: str = "mean", keys=("symbol",), order: str = "date",
               block: float | None = None) -> DataFrame:
    """``lowest_low``, ``highest_high``, ``stoch_osc``; mode ``mean`` or ``minmax``."""
    keys = list(keys)
    h = halo.blocked(bars, keys, order, preceding=n - 1, block=block)
    s = _Spec(keys)
    if mode == "mean":
        lo, hi = s.sma("low", n), s.sma("high", n)
    elif mode == "minmax":
        lo, hi = s.fmin("low", n), s.fmax("high", n)
    else:
        raise ValueError(mode)
    h = h.withColumns({"lowest_low": lo, "highest_high": hi})
    h = h.withColumn("stoch_osc", stoch_expr("close", "lowest_low", "highest_high"))
    return halo.drop_helpers(halo.core(h))


def next_close_target(features: DataFrame, col: str = "close", keys=("symbol",), order: str = "date",
                      block: float | None = None) -> DataFrame:
    """``target`` = next bar's ``col``; the last bar per symbol is dropped."""
    keys = list(keys)
    h = halo.blocked(halo.drop_helpers(features), keys, order, following=1, block=block)
    h = h.withColumn("target", _Spec(keys).lead(col, 1))
    return halo.core(h).where(F.col("target").isNotNull())
