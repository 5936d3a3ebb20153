"""Split and sequence properties."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from barflow.operators import scale as sc
from barflow.operators import sequences as sq
from barflow.operators import split as sp


def _series(spark, lengths):
    rows = []
    for s, n in lengths.items():
        for i in range(n):
            rows.append((s, dt.date(2010, 1, 1) + dt.timedelta(days=i), float(i * i % 17)))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["symbol", "date", "close"]))


def test_chrono_split_sizes(spark):
    lengths = {"a": 10, "b": 101, "c": 1}
    s = sp.chrono_split(_series(spark, lengths)).toPandas()
    for sym, n in lengths.items():
        g = s[s.symbol == sym].sort_values("date")
        k = int(np.floor(0.8 * n))
        assert (g["split"].iloc[:k] == "train").all() and (g["split"].iloc[k:] == "test").all()
        assert len(g) == n


def test_except_all_matches_split(spark):
    df = _series(spark, {"a": 30})
    s = sp.chrono_split(df)
    train = s.where(F.col("split") == "train").select("symbol", "date", "close")
    test = sp.except_all_split(df, train)
    assert test.count() == s.where(F.col("split") == "test").count()


def test_lookback_counts_and_alignment(spark):
    lengths = {"a": 12, "short": 3}
    df = _series(spark, lengths)
    seq = sq.lookback_sequences(df, "close", 5).toPandas()
    assert len(seq[seq.symbol == "a"]) == 12 - 5
    assert len(seq[seq.symbol == "short"]) == 0
    pdf = df.toPandas().sort_values("date")
    a = pdf[pdf.symbol == "a"]["close"].tolist()
    first = seq[seq.symbol == "a"].sort_values("date").iloc[0]
    assert list(first["x"]) == a[0:5] and first["y"] == a[5]
    last = sq.lookback_sequences(df, "close", 5, drop_last=True).where(F.col("symbol") == "a").count()
    assert last == 12 - 5 - 1


def test_difference_then_cumsum_is_identity(spark):
    df = _series(spark, {"a": 20})
    d = sq.difference(df, "close", 1).toPandas().sort_values("date")
    base = df.toPandas().sort_values("date")["close"].to_numpy()
    rebuilt = base[0] + np.cumsum(d["diff_1"].to_numpy())
    assert np.allclose(rebuilt, base[1:])


def test_inverse_scale_roundtrip(spark):
    df = _series(spark, {"a": 20, "b": 7})
    stats = sc.fit_minmax(df, ["close"])
    back = sc.inverse_minmax(sc.apply_minmax(df, stats, ["close"]), stats, ["close"]).toPandas()
    assert np.allclose(back["close"], back["close_restored"])


def test_time_folds_are_contiguous(spark):
    f = sp.time_folds(_series(spark, {"a": 9}), 3).toPandas().sort_values("date")
    assert f["fold"].tolist() == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_scale_and_save_writes_three_tables(spark):
    from barflow.session import scratch_path

    df = _series(spark, {"a": 20, "b": 10})
    s = sp.chrono_split(df)
    out = scratch_path(spark, "t-scale")
    tr, te, stats = sc.scale_and_save(spark, s.where(F.col("split") == "train"), s.where(F.col("split") == "test"),
                                      ["close"], out)
    assert spark.read.parquet(f"{out}/scaler").count() == 2
    assert spark.read.parquet(f"{out}/train").count() + spark.read.parquet(f"{out}/test").count() == 30
    vals = spark.read.parquet(f"{out}/train").toPandas()["close_scaled"]
    assert vals.between(0, 1).all()
