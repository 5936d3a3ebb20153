"""Row-frame rows of a bar stream from keyed state.

For each symbol the state holds the last bars that were given out (a ring, as
deep as the deepest frame less one) and the bars still ahead of the watermark.
When the watermark passes a bar, all bars before it are known, so it is given
out with its frames and moves into the ring. A timer wakes a symbol whose next
bar has been passed though no new one came. State is bounded by the ring and
the bars within the delay, whatever the length of the stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barflow import ensure_importable

#: Columns of a bar in the state: event time in milliseconds, then prices (NaN for NULL).
_TIME, _CLOSE, _HIGH, _LOW = range(4)
_WIDTH = 4
CHANGES = ("prev_close", "change_pct")
INDICATORS = (*CHANGES, "ma_10", "ma_50", "rsi", "upper_bb", "lower_bb", "stoch_osc")
#: Frames worked out at once (rows of a frame matrix).
_CHUNK = 16_384


def _divide(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=(b != 0) & ~np.isnan(b))


def _frames(values: np.ndarray, n: int) -> Iterator[tuple[slice, np.ndarray]]:
    """The trailing ``n`` values of every row, a chunk at a time; NaN before the first."""
    padded = np.concatenate([np.full(n - 1, np.nan), values])
    view = np.lib.stride_tricks.sliding_window_view(padded, n)
    for lo in range(0, len(values), _CHUNK):
        yield slice(lo, min(lo + _CHUNK, len(values))), view[lo : lo + _CHUNK]


def mean(values: np.ndarray, n: int) -> np.ndarray:
    """Mean of the values that are there among the trailing ``n``."""
    out = np.empty(len(values))
    for at, frame in _frames(values, n):
        out[at] = _divide(np.nansum(frame, axis=1), (~np.isnan(frame)).sum(axis=1).astype(float))
    return out


def deviation(values: np.ndarray, n: int) -> np.ndarray:
    """Sample deviation of the values that are there among the trailing ``n`` (two at least)."""
    out = np.empty(len(values))
    for at, frame in _frames(values, n):
        count = (~np.isnan(frame)).sum(axis=1).astype(float)
        centre = _divide(np.nansum(frame, axis=1), count)
        out[at] = np.sqrt(_divide(np.nansum((frame - centre[:, None]) ** 2, axis=1), np.where(count > 1, count - 1, np.nan)))
    return out


def changes(bars: np.ndarray) -> dict[str, np.ndarray]:
    """``CHANGES`` of bars in order."""
    close = bars[:, _CLOSE]
    prev = np.concatenate([[np.nan], close[:-1]])[: len(close)]
    return {"prev_close": prev, "change_pct": _divide(close - prev, prev) * 100.0}


def indicators(bars: np.ndarray) -> dict[str, np.ndarray]:
    """``INDICATORS`` of bars in order: MA10/50, RSI14, Bollinger(20, 2), stochastic(14, mean form)."""
    out = changes(bars)
    close = bars[:, _CLOSE]
    diff = close - out["prev_close"]
    gain, loss = np.where(diff > 0, diff, 0.0), np.where(diff < 0, -diff, 0.0)  # no previous close: neither
    middle, spread = mean(close, 20), deviation(close, 20)
    low, high = mean(bars[:, _LOW], 14), mean(bars[:, _HIGH], 14)
    strength = _divide(mean(gain, 14), mean(loss, 14))
    return out | {
        "ma_10": mean(close, 10), "ma_50": mean(close, 50), "rsi": 100.0 - _divide(np.full(len(close), 100.0), 1.0 + strength),
        "upper_bb": middle + 2.0 * spread, "lower_bb": middle - 2.0 * spread, "stoch_osc": _divide(100.0 * (close - low), high - low),
    }


def one_for_each_time(bars: np.ndarray) -> np.ndarray:
    """Bars in order of time; of several at one time the one with the largest close, high and low (NULL is the least)."""
    rank = np.nan_to_num(bars, nan=-np.inf)
    order = np.lexsort((rank[:, _LOW], rank[:, _HIGH], rank[:, _CLOSE], bars[:, _TIME]))
    bars = bars[order]
    return bars[np.append(bars[1:, _TIME] != bars[:-1, _TIME], True)] if len(bars) else bars


def advance(ring: np.ndarray, ahead: np.ndarray, new: np.ndarray, watermark: float, depth: int, frames: Callable, idle: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """One step of a symbol: the ring and the bars ahead afterwards, the bars passed by the watermark and their frames.

    ``watermark`` is that of the bars before this step: a new bar before it is
    late and left out. A gap of more than ``idle`` ends a series.
    """
    ahead = one_for_each_time(np.concatenate([ahead, new[new[:, _TIME] >= watermark]]))
    n = int(np.searchsorted(ahead[:, _TIME], watermark, "left"))  # before the watermark
    passed, ahead = ahead[:n], ahead[n:]
    series = np.concatenate([ring, passed])
    begins = np.flatnonzero(np.diff(series[:, _TIME]) > idle) + 1 if idle is not None else []
    pieces = np.split(series, begins)
    found = [frames(piece) for piece in pieces] if n else []
    return pieces[-1][-depth:], ahead, passed, {c: np.concatenate([f[c] for f in found])[len(ring) :] for c in found[0]} if n else {}


def _matrix(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.float64).reshape(-1, _WIDTH)


def _step(frames: Callable, columns: tuple[str, ...], depth: int, idle_ms: int | None):
    """The state function: bars of one symbol, or its timer."""

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring, ahead = map(_matrix, state.get) if state.exists else (np.empty((0, _WIDTH)),) * 2
        parts = [pdf[["_ms", "close", "high", "low"]].to_numpy(np.float64) for pdf in pdfs] if not state.hasTimedOut else []
        new = np.concatenate(parts) if parts else np.empty((0, _WIDTH))
        watermark = state.getCurrentWatermarkMs()
        ring, ahead, passed, found = advance(ring, ahead, new, watermark, depth, frames, idle_ms)
        last = ring[-1, _TIME] if len(ring) else None
        if not len(ahead) and (last is None or idle_ms is not None and last + idle_ms < watermark):
            if state.exists:
                state.remove()  # nothing to give out, or forgotten
        else:
            state.update((ring.tobytes(), ahead.tobytes()))
            wake = ahead[0, _TIME] if len(ahead) else last + idle_ms if idle_ms is not None else None
            if wake is not None:
                state.setTimeoutTimestamp(int(max(wake, watermark + 1)))
        if len(passed):
            out = pd.DataFrame({"symbol": pd.Series([key[0]] * len(passed), dtype=object), "_ms": passed[:, _TIME].astype(np.int64), "close": passed[:, _CLOSE]})
            yield out.assign(**{c: found[c] for c in columns})

    return run


def milliseconds(interval: str) -> int:
    """An interval such as ``30 days`` in milliseconds."""
    return int(pd.Timedelta(interval).total_seconds() * 1000)


def rows(bars: DataFrame, frames: Callable, columns: tuple[str, ...], depth: int, delay: str, idle: str | None, order: str) -> DataFrame:
    """``symbol, order, close`` and the frame columns of a bar stream, once the watermark has passed a bar.

    Bars without a time have no place in a series and are left out.
    """
    ensure_importable(bars.sparkSession)
    kind = bars.schema[order].dataType
    timed = bars.where(F.col(order).isNotNull()).withColumn("_et", F.col(order).cast("timestamp")).withWatermark("_et", delay)
    timed = timed.select("symbol", "_et", F.unix_millis("_et").cast("double").alias("_ms"), *[F.col(c).cast("double").alias(c) for c in ("close", "high", "low")])
    out = T.StructType([T.StructField("symbol", bars.schema["symbol"].dataType), T.StructField("_ms", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("close", *columns)]])
    state = T.StructType([T.StructField("ring", T.BinaryType()), T.StructField("ahead", T.BinaryType())])
    step = _step(frames, columns, depth, None if idle is None else milliseconds(idle))
    found = timed.groupBy("symbol").applyInPandasWithState(step, out, state, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select("symbol", F.timestamp_millis("_ms").cast(kind).alias(order), "close", *columns)
