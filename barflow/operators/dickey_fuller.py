"""Distribution of the Dickey-Fuller statistic (regression with a constant), and p-values from it.

``simulate`` draws random walks in Spark tasks (seeded by size and chunk, so a
task that runs again draws the same) and adds up fine histograms of the
statistic by sample size; ``quantiles`` reads the quantiles off the summed
histograms and ``surface`` fits each as a polynomial in 1/T. ``SURFACE`` holds
the coefficients that ``python -m barflow.operators.dickey_fuller`` found.

A p-value is interpolated on that surface: the quantiles for T are known at the
probabilities of the table, and between two of them the log odds of p run
linearly in the statistic (beyond the first and last along the nearest piece), so
p rises with the statistic and stays between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Sample sizes (regression rows) and walks drawn for each.
SIZES = {15: 2_000_000, 20: 2_000_000, 25: 2_000_000, 35: 2_000_000, 50: 2_000_000, 75: 2_000_000, 100: 2_000_000, 150: 1_000_000, 250: 1_000_000, 500: 500_000, 1000: 500_000}
PROBABILITIES = (0.001, 0.0025, 0.005, 0.01, 0.015, 0.025, 0.05, 0.075, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.925, 0.95, 0.975, 0.985, 0.99, 0.995, 0.9975, 0.999)
SEED = 20240601
#: Bins of the histogram for one unit of the statistic, and walks of a chunk.
_BINS, _CHUNK = 512, 20_000
#: The smallest T that the surface is used for (shorter series take its values).
LEAST = 12

# For each probability c0, c1, c2, c3 of the quantile c0 + c1/T + c2/T^2 + c3/T^3 (made by this module, see above).
SURFACE: dict[float, tuple[float, float, float, float]] = {
    0.001: (-4.0975, -12.7661, -39.8465, -357.5055),
    0.0025: (-3.8439, -10.0885, -42.8775, -49.3518),
    0.005: (-3.6451, -7.8824, -42.4673, 76.2453),
    0.01: (-3.4328, -6.4545, -14.4697, -127.4713),
    0.015: (-3.2996, -5.7452, 0.6303, -221.5485),
    0.025: (-3.1252, -4.1548, -12.1016, -36.6453),
    0.05: (-2.8634, -2.7593, -3.6768, -72.079),
    0.075: (-2.6952, -2.0343, -1.0492, -60.5367),
    0.1: (-2.5674, -1.5482, 1.7229, -73.6004),
    0.15: (-2.3717, -0.8823, 3.1483, -65.394),
    0.2: (-2.2194, -0.2685, -1.3748, -15.5059),
    0.25: (-2.0884, -0.009, -0.3103, -11.2822),
    0.3: (-1.9722, 0.2823, -2.2479, 13.4713),
    0.4: (-1.7628, 0.5788, -0.2324, 0.418),
    0.5: (-1.5669, 0.8026, -0.2112, 2.7268),
    0.6: (-1.3669, 0.8573, 3.892, -32.1484),
    0.7: (-1.1447, 1.0459, 3.5321, -24.9935),
    0.75: (-1.0147, 1.1711, 2.031, 1.974),
    0.8: (-0.8628, 1.1934, 7.3046, -50.8008),
    0.85: (-0.679, 1.4639, 2.3671, -2.4681),
    0.9: (-0.4391, 1.568, 2.3497, 8.1597),
    0.925: (-0.2835, 1.7675, -1.6318, 50.2797),
    0.95: (-0.0773, 1.822, -0.5287, 52.1505),
    0.975: (0.2406, 1.7486, 15.1069, -104.6806),
    0.985: (0.4504, 2.0814, 14.1382, -94.6952),
    0.99: (0.6084, 2.2126, 19.7292, -152.8449),
    0.995: (0.8635, 2.4153, 22.8055, -131.7862),
    0.9975: (1.097, 2.2814, 52.2564, -390.5938),
    0.999: (1.3877, 2.4374, 67.288, -370.533),
}


def statistics(size: int, walks: int, rng: np.random.Generator) -> np.ndarray:
    """Statistics of ``walks`` random walks of ``size`` regression rows: slope over its standard error."""
    step = rng.standard_normal((walks, size))
    level = np.cumsum(step, axis=1) - step
    level -= level.mean(axis=1, keepdims=True)
    step -= step.mean(axis=1, keepdims=True)
    xx, xy, yy = ((a * b).sum(axis=1) for a, b in ((level, level), (level, step), (step, step)))
    return xy / xx / np.sqrt((yy - xy * xy / xx) / (size - 2) / xx)


def simulate(spark: SparkSession, sizes: dict[int, int] | None = None, seed: int = SEED) -> DataFrame:
    """``size, bin, n``: how many statistics of each sample size fall into each bin of the histogram."""
    sizes = sizes or SIZES
    chunks = [(t, c, min(_CHUNK, n - lo)) for t, n in sizes.items() for c, lo in enumerate(range(0, n, _CHUNK))]

    def run(batches):
        for pdf in batches:
            for t, c, n in zip(pdf["size"], pdf["chunk"], pdf["walks"]):
                found = statistics(int(t), int(n), np.random.default_rng([seed, int(t), int(c)]))
                bins, counts = np.unique(np.floor(found * _BINS).astype(np.int64), return_counts=True)
                yield pd.DataFrame({"size": np.int64(t), "bin": bins, "n": counts.astype(np.int64)})

    tasks = spark.createDataFrame(chunks, "size long, chunk long, walks long").repartition(min(len(chunks), 64), "size", "chunk")
    return tasks.mapInPandas(run, "size long, bin long, n long").groupBy("size", "bin").agg(F.sum("n").alias("n"))


def quantiles(histogram: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """``size, probability, quantile`` by linear interpolation within the bin that holds the probability."""
    w = Window.partitionBy("size")
    cum = histogram.withColumns({"upto": F.sum("n").over(w.orderBy("bin")), "total": F.sum("n").over(w)})
    wanted = cum.withColumn("probability", F.explode(F.array(*map(F.lit, probabilities))))
    rank = F.col("probability") * F.col("total")
    inside = wanted.where((rank <= F.col("upto")) & (rank > F.col("upto") - F.col("n")))
    return inside.select("size", "probability", ((F.col("bin") + (rank - (F.col("upto") - F.col("n"))) / F.col("n")) / _BINS).alias("quantile"))


def surface(table: DataFrame, sizes: dict[int, int] | None = None) -> dict[float, tuple[float, ...]]:
    """Coefficients of each probability's quantile in powers of 1/T, weighted by the walks (the table has a row for each size and probability)."""
    sizes = sizes or SIZES
    found: dict[float, tuple[float, ...]] = {}
    pdf = table.toPandas().sort_values(["probability", "size"])
    for p, own in pdf.groupby("probability"):
        t = own["size"].to_numpy(float)
        weight = np.sqrt([sizes[int(s)] for s in t])
        x = np.stack([t**-k for k in range(4)], axis=1)
        coef = np.linalg.lstsq(x * weight[:, None], own["quantile"].to_numpy() * weight, rcond=None)[0]
        found[float(p)] = tuple(round(float(c), 4) for c in coef)
    return found


def quantile(probability: float, n: float) -> float:
    """The statistic's quantile for ``n`` regression rows, at a probability of the table."""
    t = max(float(n), LEAST)
    return sum(c / t**k for k, c in enumerate(SURFACE[probability]))


def p_value(stat: Column, n: Column) -> Column:
    """Probability of a statistic at most ``stat`` under a unit root, for ``n`` regression rows; NULL for NULL."""
    t = F.greatest(n.cast("double"), F.lit(float(LEAST)))
    powers = [F.lit(1.0), t, t * t, t * t * t]
    table = F.array(*[F.array(F.lit(float(np.log(p / (1 - p)))), *map(F.lit, coef)) for p, coef in sorted(SURFACE.items())])
    points = F.transform(table, lambda e: F.array(e[0], sum((e[k + 1] / powers[k] for k in range(1, 4)), e[1])))  # (log odds, quantile)
    below = F.size(F.filter(points, lambda e: e[1] <= stat))
    at = F.greatest(F.lit(1), F.least(F.lit(len(SURFACE) - 1), below))
    piece = F.slice(points, at, F.lit(2))
    odds = F.element_at(F.transform(F.array(piece), lambda e: e[0][0] + (e[1][0] - e[0][0]) * (stat - e[0][1]) / (e[1][1] - e[0][1])), 1)
    return F.when(stat.isNotNull() & ~F.isnan(stat) & n.isNotNull(), F.lit(1.0) / (F.lit(1.0) + F.exp(-odds)))


if __name__ == "__main__":
    from barflow.session import build_session

    for p, coef in surface(quantiles(simulate(build_session(app="dickey-fuller")))).items():
        print(f"    {p}: {coef},")
