"""barflow: time-series bars, indicators, models and streams on Spark."""

from __future__ import annotations

import os

_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ensure_importable(spark) -> None:
    """Let Python workers import this package (pandas functions are pickled by reference).

    Adds the package root to the ``PYTHONPATH`` that PySpark hands to its
    workers (``SparkContext.environment``); on a cluster without a shared
    checkout ship the package with ``--py-files`` instead.
    """
    env = spark.sparkContext.environment
    parts = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in parts:
        env["PYTHONPATH"] = os.pathsep.join([*parts, _ROOT])
