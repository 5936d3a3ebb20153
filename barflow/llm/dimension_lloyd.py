"""Centroid clustering by dimension-sharded Lloyd rounds on integer vectors.

The table is cut both ways once: rows into blocks, columns into shards, and
written as (block, shard, slice). In a round each slice meets the slices of all
centroids with its columns and gives exact partial distances for its block. The
partial distances of a block (one row for each shard) are added up, the smallest
sum names the centroid, and the block's assignment goes back to its shards, where
each shard adds up its own columns by centroid and makes its own centroid slice
anew. What reaches the driver in a round is the centroids: ``k`` rows of
``length`` integers.

A block has at most ``BLOCK_ROWS`` rows, so every group has a bounded size: one
record for each shard. Sums of a shard are added in two steps, so that no task
gets a record from every other task.

Components are ``floor(scale * x)`` with x as double, exact for any finite x. If
they are so large that 64-bit integers could overflow, Python's integers take
over; a distance or a sum of distances beyond the range of a long is given as
the largest long. Rows whose vector is NULL, has another length or holds a NULL
or non-finite component take no part. A row without an id is clustered, but
starts a centroid only after all rows with one; rows that repeat an id or a
vector are rows of their own. Fewer rows than ``k`` give fewer centroids, none
gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import text as tx
from barflow.llm import vectors as vc

BLOCK_ROWS = 2_048
#: Columns of a shard.
SHARD_COLUMNS = 16
#: Below this size, 4,096 squares of differences add up within a long.
_SMALL = 1 << 24
_MOST = (1 << 63) - 1


def to_integers(x: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)``, as int64 if all are small, else as Python integers."""
    if x.size == 0 or np.abs(x).max() < _SMALL / scale:
        return np.floor(x * scale).astype(np.int64)
    exact = lambda v: int(v) * scale if abs(v) >= 2.0**53 else math.floor(v * scale)  # noqa: E731  a large double is whole
    return np.array([[exact(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


def fitting(a: np.ndarray) -> np.ndarray:
    """As int64 where squares and sums of the values can't overflow, else as Python integers."""
    if a.size == 0:
        return a.astype(np.int64)
    return a.astype(np.int64 if max(abs(int(a.max())), abs(int(a.min()))) < _SMALL and a.shape[-1] <= 4_096 else object)


def partial_distances(slice_: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances over a shard's columns: a row for each vector, a column for each centroid."""
    x, c = slice_, centroids
    if x.dtype == object or c.dtype == object:
        x, c = x.astype(object), c.astype(object)
    out = [((x - one) ** 2).sum(axis=1) for one in c]
    return np.stack(out, axis=1)


def _dump(a: np.ndarray) -> bytes:
    return pickle.dumps(a, protocol=5)


def cut(df: DataFrame, vec_id: str, vector: str, length: int, scale: int, block_rows: int, columns: int) -> DataFrame:
    """The written table of slices; a block's ids lie beside its first shard."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(vc.finite("vector") & (F.size("vector") == length))

    def emit(x: np.ndarray, ids: list, block: int):
        shards = [x[:, lo : lo + columns] for lo in range(0, length, columns)]
        n = len(shards)
        return pa.record_batch(
            [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array([_dump(fitting(s)) for s in shards], pa.binary()), pa.array([ids] + [None] * (n - 1), pa.list_(pa.int64()))],
            names=["block", "shard", "slice", "ids"],
        )

    def blocks(batches):
        held, ids, counter = [], [], 0
        for batch in batches:
            x = vc.matrix(batch.column("vector"))
            for lo in range(0, len(x), block_rows):
                held.append(to_integers(x[lo : lo + block_rows], scale))
                ids += batch.column("vec_id").slice(lo, block_rows).to_pylist()
                if len(ids) >= block_rows:
                    whole = np.concatenate(held)
                    yield emit(whole[:block_rows], ids[:block_rows], (TaskContext.get().partitionId() << 32) | counter)
                    held, ids, counter = [whole[block_rows:]], ids[block_rows:], counter + 1
        if ids:
            yield emit(np.concatenate(held), ids, (TaskContext.get().partitionId() << 32) | counter)

    return tx.written(rows.mapInArrow(blocks, "block long, shard int, slice binary, ids array<long>"), "lloyd-slices")


def first_centroids(df: DataFrame, vec_id: str, vector: str, length: int, scale: int, k: int, seed: int) -> np.ndarray:
    """The ``k`` usable vectors whose ``seed:id`` has the smallest SHA-256."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector")).where(vc.finite("vector") & (F.size("vector") == length))
    picked = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)).orderBy(F.col("h").asc_nulls_last(), "vector").limit(k)
    x = np.array([r["vector"] for r in picked.collect()], np.float64)
    return to_integers(x.reshape(len(x), length), scale)


def _distances(slices: DataFrame, centroids: np.ndarray, columns: int) -> DataFrame:
    """Exact partial distances of every slice: ``block, part``."""
    pieces = [fitting(centroids[:, lo : lo + columns]) for lo in range(0, centroids.shape[1], columns)]

    def part(batches):
        for batch in batches:
            got = [_dump(partial_distances(pickle.loads(s), pieces[k])) for s, k in zip(batch.column("slice").to_pylist(), batch.column("shard").to_pylist(), strict=True)]
            yield pa.record_batch([batch.column("block"), pa.array(got, pa.binary())], names=["block", "part"])

    return slices.select("block", "shard", "slice").mapInArrow(part, "block long, part binary")


def _add(parts) -> np.ndarray:
    total = None
    for p in parts:
        p = pickle.loads(p)
        total = p if total is None else total + p
    return total


def _assign(parts: pa.Table) -> pa.Table:
    """The nearest centroid of every vector of a block (ties: the smaller number), and its distance."""
    total = _add(parts["part"].to_pylist())
    best = np.argmin(total, axis=1).astype(np.int32)
    far = [min(int(d), _MOST) for d in total[np.arange(len(total)), best]]
    return pa.table({"block": pa.array([parts["block"][0].as_py()], pa.int64()), "cluster": pa.array([best.tolist()], pa.list_(pa.int32())), "distance": pa.array([far], pa.list_(pa.int64()))})


def assignments(slices: DataFrame, centroids: np.ndarray, columns: int) -> DataFrame:
    """``block, cluster, distance``: partial distances added up by block."""
    return _distances(slices, centroids, columns).groupBy("block").applyInArrow(_assign, "block long, cluster array<int>, distance array<long>")


def update(slices: DataFrame, assigned: DataFrame, centroids: np.ndarray, columns: int) -> np.ndarray:
    """New centroids: each shard's floor of sum over count, an empty centroid as it was."""
    k = len(centroids)
    before = [centroids[:, lo : lo + columns] for lo in range(0, centroids.shape[1], columns)]

    def local(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, raw, cluster in zip(*(batch.column(c).to_pylist() for c in ("shard", "slice", "cluster")), strict=True):
                x, at = pickle.loads(raw), np.asarray(cluster)
                own = np.zeros((k, x.shape[1] + 1), object)
                for c in np.unique(at):
                    rows = x[at == c]
                    own[c] = [*(int(v) for v in rows.sum(axis=0)), len(rows)]
                sums[shard] = sums[shard] + own if shard in sums else own
        n = TaskContext.get().partitionId() % 256
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array([n] * len(sums), pa.int32()), pa.array([_dump(s) for s in sums.values()], pa.binary())], names=["shard", "deal", "sums"])

    def together(parts: pa.Table) -> pa.Table:
        return pa.table({"shard": pa.array([parts["shard"][0].as_py()], pa.int32()), "sums": pa.array([_dump(_add(parts["sums"].to_pylist()))], pa.binary())})

    def anew(parts: pa.Table) -> pa.Table:
        shard, total = parts["shard"][0].as_py(), _add(parts["sums"].to_pylist())
        own = [[int(t) // int(row[-1]) for t in row[:-1]] if row[-1] else [int(v) for v in old] for row, old in zip(total, before[shard], strict=True)]
        return pa.table({"shard": pa.array([shard], pa.int32()), "centroids": pa.array([_dump(np.array(own, dtype=object))], pa.binary())})

    joined = slices.select("block", "shard", "slice").join(assigned.select("block", "cluster"), "block").select("shard", "slice", "cluster")
    sums = joined.mapInArrow(local, "shard int, deal int, sums binary")
    sums = sums.groupBy("shard", "deal").applyInArrow(together, "shard int, sums binary")
    new = sums.groupBy("shard").applyInArrow(anew, "shard int, centroids binary").collect()
    return fitting(np.concatenate([pickle.loads(r["centroids"]) for r in sorted(new, key=lambda r: r["shard"])], axis=1))


def lloyd(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", length: int = 64, scale: int = 1024, k: int = 8, rounds: int = 10, seed: int = 3,
          block_rows: int = BLOCK_ROWS, columns: int = SHARD_COLUMNS) -> tuple[DataFrame, list[list[int]]]:
    """``vec_id, cluster, distance`` of every usable vector after ``rounds`` rounds, and the centroids."""
    centroids = first_centroids(df, vec_id, vector, length, scale, k, seed)
    if not len(centroids):
        return df.sparkSession.createDataFrame([], "vec_id long, cluster int, distance long"), []
    centroids = fitting(centroids)
    slices = cut(df, vec_id, vector, length, scale, block_rows, columns)
    for _ in range(rounds):
        centroids = update(slices, assignments(slices, centroids, columns), centroids, columns)
    last = assignments(slices, centroids, columns).join(slices.where("shard = 0").select("block", "ids"), "block")
    flat = last.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("v")).select(F.col("v.ids").alias("vec_id"), "v.cluster", "v.distance")
    return tx.written(flat, "lloyd-assigned"), [[int(v) for v in c] for c in centroids]


def report(df: DataFrame, **options) -> DataFrame:
    """``lloyd`` with the distance summed over clusters and over all, and digests of the centroids."""
    found, centroids = lloyd(df, **options)
    digests = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    by = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    held = {r["cluster"]: min(int(r["s"]), _MOST) for r in by}
    total = min(sum(int(r["s"]) for r in by), _MOST)
    rows = [(c, held.get(c, 0), total, d) for c, d in digests]
    sums = df.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
