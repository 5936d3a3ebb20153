"""Tables of fitted models, one row per key (ARMA coefficients, stacking weights, min-max ranges), kept by version.

A version is a folder of Parquet files below ``path``; writing one never touches
another, and a reader that names none gets the newest. What a version holds is
any DataFrame whose rows are known by their keys, so saving, loading and scoring
are joins and column expressions for one series or for millions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "version"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions below ``path``, in order (folder names only; no row is read)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(root)] if files.exists(root) else []
    whole = [n for n in names if n.startswith(f"{VERSION}=") and files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=")[1]) for n in whole)


def save_models(models: DataFrame, path: str) -> int:
    """Write ``models`` as the next version; its number. A write that breaks off leaves no version."""
    number = max(versions(models.sparkSession, path), default=0) + 1
    models.write.mode("overwrite").parquet(f"{path}/{VERSION}={number}")
    return number


def load_models(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The models of ``version``, or of the newest."""
    known = versions(spark, path)
    if not known or version is not None and version not in known:
        raise ValueError(f"no version {version or ''} below {path}: {known}")
    return spark.read.parquet(f"{path}/{VERSION}={version or known[-1]}")


def compare_versions(spark: SparkSession, path: str, keys: tuple[str, ...], column: str, old: int, new: int) -> DataFrame:
    """``keys, old, new``: one column of two versions side by side (keys of either)."""
    sides = [load_models(spark, path, v).select(*keys, F.col(column).alias(name)) for v, name in ((old, "old"), (new, "new"))]
    return sides[0].join(sides[1], list(keys), "full")
