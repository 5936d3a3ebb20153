"""Least squares per group from Gram sums.

The data pass is one grouped aggregate of ``sum(z_i * z_j)``, ``sum(z_i * y)``,
``sum(y * y)`` and ``count`` (partial aggregation, so a hot group is reduced on
the map side). Only the k x k systems, one per group, are solved in numpy
inside ``mapInPandas``; the table of systems is small and stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow import ensure_importable


def gram(df: DataFrame, group: Sequence[str], xs: Sequence[Column], y: Column, where: Column | None = None) -> DataFrame:
    """``group..., g: array<double>, n`` with g = upper triangle of [X y]'[X y] (row-major).

    Rows where any regressor or ``y`` is NULL are skipped. Each Arrow batch is
    reduced to one partial matrix per group in numpy; the partials are summed
    element-wise by a grouped Spark aggregate on ``(group, position)`` (map-side
    combined, bounded by the matrix size), so a hot group is still reduced in
    parallel and nothing per-row reaches a single task.
    """
    group = list(group)
    cols = list(xs) + [y]
    ok = F.lit(True)
    for c in cols:
        ok = ok & c.isNotNull()
    if where is not None:
        ok = ok & where
    k1 = len(cols)
    zcols = [f"_z{i}" for i in range(k1)]
    base = df.where(ok).select(*group, *[c.cast("double").alias(z) for c, z in zip(cols, zcols)])
    iu = np.triu_indices(k1)
    gschema = ", ".join(f"{c} {base.schema[c].dataType.simpleString()}" for c in group)

    def partial(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            z = pdf[zcols].to_numpy(dtype=float)
            out_keys, out_g = [], []
            groups = pdf.groupby(group, sort=False, dropna=False).indices.items() if group else [((), np.arange(len(pdf)))]
            for key, idx in groups:
                zg = z[idx]
                m = zg.T @ zg
                out_keys.append(key if isinstance(key, tuple) else (key,))
                out_g.append(np.append(m[iu], float(len(idx))).tolist())
            res = pd.DataFrame(out_keys, columns=group)
            res["g"] = out_g
            yield res

    ensure_importable(base.sparkSession)
    parts = base.mapInPandas(partial, f"{gschema}, g array<double>" if group else "g array<double>")
    cells = parts.select(*group, F.posexplode("g").alias("_pos", "_val"))
    summed = cells.groupBy(*group, "_pos").agg(F.sum("_val").alias("_val"))
    packed = summed.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("_pos", "_val"))).alias("_l"))
    vals = F.transform("_l", lambda e: e["_val"])
    return packed.select(
        *group,
        F.slice(vals, 1, len(iu[0])).alias("g"),
        F.element_at(vals, -1).cast("long").alias("n"),
    )


def unpack(g: Sequence[float], k: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(X'X, X'y, y'y) from the packed upper triangle of a (k+1) x (k+1) matrix."""
    m = np.zeros((k + 1, k + 1))
    it = iter(g)
    for i in range(k + 1):
        for j in range(i, k + 1):
            m[i, j] = m[j, i] = next(it)
    return m[:k, :k], m[:k, k], m[k, k]


def ols_from_gram(xtx: np.ndarray, xty: np.ndarray, yty: float, n: int, cols: Sequence[int] | None = None):
    """Coefficients, standard errors, SSR for a subset of regressors (indices; the first is the constant).

    The system is centred and scaled before it is solved; a system without full
    rank (a constant or collinear regressor, too few rows) gives NaN throughout.
    """
    idx = list(range(len(xty))) if cols is None else list(cols)
    k = len(idx)
    nan = np.full(k, np.nan), np.full(k, np.nan), float("nan")
    if n <= k or xtx[idx[0], idx[0]] <= 0:
        return nan
    a, b = xtx[np.ix_(idx, idx)], xty[idx]
    mean, y_mean = a[0, 1:] / n, b[0] / n
    cov, cxy, cyy = a[1:, 1:] - n * np.outer(mean, mean), b[1:] - n * mean * y_mean, yty - n * y_mean * y_mean
    level = np.diag(a)[1:]
    spread = np.sqrt(np.maximum(np.diag(cov), 0.0))
    if k > 1 and (np.diag(cov) <= 1e-12 * np.maximum(level, 1e-300)).any():
        return nan
    corr = cov / np.outer(spread, spread) if k > 1 else np.zeros((0, 0))
    if k > 1 and np.linalg.eigvalsh(corr)[0] <= 1e-12:
        return nan
    inv = np.linalg.inv(corr) / np.outer(spread, spread) if k > 1 else corr
    slopes = inv @ cxy
    ssr = float(max(cyy - 2 * slopes @ cxy + slopes @ cov @ slopes, 0.0))
    s2 = ssr / (n - k)
    var = np.concatenate([[1.0 / n + mean @ inv @ mean], np.diag(inv)]) * s2
    return np.concatenate([[y_mean - slopes @ mean], slopes]), np.sqrt(np.maximum(var, 0.0)), ssr


def aic_ls(ssr: float, n: int, k: int) -> float:
    """Gaussian AIC of a least-squares fit with k parameters (constant terms kept)."""
    if n <= 0 or ssr <= 0:
        return float("nan")
    return float(n * (np.log(2 * np.pi) + np.log(ssr / n) + 1) + 2 * k)
