"""Linear recurrences along ordered series, without one task per series.

``y_t = x_t - c_1 y_{t-1} - ... - c_q y_{t-q}``, coefficients constant within a
key. The values that a block of rows passes on are an affine function of those
it gets: ``end = M^n start + b``, with M the companion matrix of the recurrence,
n the rows of the block and b what the block gives from a zero start. So

1. every block runs from zero and keeps ``n`` and ``b`` (one row for each block),
2. each key composes these maps in order: what every block starts from,
3. every block runs again from its start.

Blocks hold at most ``halo.DEFAULT_BLOCK_ROWS`` rows, so a long series is spread
over many tasks; the second step has one row for each block of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow import ensure_importable
from barflow.operators import halo

#: Rows that one matrix product handles within a block.
_PIECE = 64


def companion(coefs: np.ndarray) -> np.ndarray:
    """The matrix that moves (y_{t-1}, ..., y_{t-q}) one step on, without input."""
    q = len(coefs)
    m = np.zeros((q, q))
    m[0] = -coefs
    m[1:, :-1] = np.eye(q - 1)
    return m


def _responses(coefs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``n`` steps make of a unit input at the first (n), and of each earlier value (n by q)."""
    q = len(coefs)
    m, state = companion(coefs), np.eye(q)
    carried = np.empty((n, q))
    for t in range(n):
        state = m @ state
        carried[t] = state[0]
    return np.concatenate([[1.0], carried[: n - 1, 0]]), carried  # an input is an earlier value one step later


def run(x: np.ndarray, coefs: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``y`` for the rows of ``x`` (a column for each series); ``start`` holds y_{-1}, ..., y_{-q} in its rows."""
    n, q = len(x), len(coefs)
    if q == 0 or n == 0:
        return x.copy()
    unit, carried = _responses(coefs, min(n, _PIECE))
    lower = np.array([[unit[i - j] if i >= j else 0.0 for j in range(len(unit))] for i in range(len(unit))])
    out, state = np.empty_like(x), start
    for lo in range(0, n, _PIECE):
        k = min(_PIECE, n - lo)
        out[lo : lo + k] = lower[:k, :k] @ x[lo : lo + k] + carried[:k] @ state
        state = np.concatenate([out[max(lo + k - q, 0) : lo + k][::-1], start])[:q] if lo + k < q else out[lo + k - q : lo + k][::-1]
    return out


def _ends(x: np.ndarray, y: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The last q values, newest first."""
    q = len(start)
    return np.concatenate([y[::-1][:q], start])[:q]


def scan(rows: DataFrame, inputs: dict[str, str], coefs: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``rows`` with a column for each of ``inputs`` (new column: input column).

    ``rows`` are core rows of the block layout (``_blk``, ``_idx``) with the
    coefficients in columns. An input that is NULL has no place in the recurrence:
    its output is NULL and the values before stay as they were (in practice the
    first rows of a series, whose lags are missing). NULL or NaN coefficients give NULL.
    """
    keys, coefs, new, xs = list(keys), list(coefs), list(inputs), list(inputs.values())
    q, k = len(coefs), len(inputs)
    if q == 0:
        return rows.withColumns({c: F.col(x) for c, x in inputs.items()})
    ensure_importable(rows.sparkSession)
    key_fields = [rows.schema[c] for c in keys]
    at = [*keys, halo.BLK]
    block_field = rows.schema[halo.BLK]

    def parts(pdf: pd.DataFrame):
        pdf = pdf.sort_values(halo.IDX, kind="stable")
        x = pdf[xs].to_numpy(float)
        c = pdf[coefs].iloc[0].to_numpy(float)
        return pdf, x, c, ~np.isnan(x).any(axis=1)

    def local(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, x, c, there = parts(pdf)
        zero = np.zeros((q, k))
        end = _ends(x[there], run(x[there], c, zero), zero)
        return pd.DataFrame([[*(pdf[f].iloc[0] for f in at), int(there.sum()), c.tolist(), end.ravel().tolist()]], columns=[*at, "n", "c", "b"])

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(halo.BLK, kind="stable")
        state, starts = np.zeros((q, k)), []
        step = companion(np.array(pdf["c"].iloc[0], float))
        power = {n: np.linalg.matrix_power(step, int(n)) for n in pdf["n"].unique()}  # most blocks are full
        for n, b in zip(pdf["n"], pdf["b"]):
            starts.append(state.ravel().tolist())
            state = power[n] @ state + np.array(b, float).reshape(q, k)
        return pdf[at].assign(_start=starts)

    doubles = T.ArrayType(T.DoubleType())
    ends = rows.groupBy(*at).applyInPandas(local, T.StructType([*key_fields, block_field, T.StructField("n", T.LongType()), T.StructField("c", doubles), T.StructField("b", doubles)]))
    starts = ends.groupBy(*keys).applyInPandas(compose, T.StructType([*key_fields, block_field, T.StructField("_start", doubles)]))
    names = rows.columns

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, x, c, there = parts(pdf)
        y = np.full(x.shape, np.nan)
        y[there] = run(x[there], c, np.array(pdf["_start"].iloc[0], float).reshape(q, k))
        return pdf[names].assign(**{name: y[:, i] for i, name in enumerate(new)})

    schema = T.StructType([*rows.schema.fields, *[T.StructField(c, T.DoubleType()) for c in new]])
    return halo.join_null_safe(rows, starts, at).groupBy(*at).applyInPandas(whole, schema)


def shrink_to_invertible(coefs: np.ndarray, most: float = 0.98) -> np.ndarray:
    """Coefficients whose recurrence dies out: ``c_j * r^j`` with the largest r of at most 1 that keeps roots within ``most``."""
    if len(coefs) == 0 or not np.isfinite(coefs).all():
        return coefs
    radius = np.abs(np.linalg.eigvals(companion(coefs))).max()
    return coefs if radius <= most else coefs * (most / radius) ** np.arange(1, len(coefs) + 1)
