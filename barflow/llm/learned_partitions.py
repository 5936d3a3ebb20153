"""Approximate nearest neighbours by learned partitions.

Fitting looks at a sample of at most ``SAMPLE`` rows (chosen by a hash of the
row, so the same rows each time). Spark tasks find each sampled row's nearest
sampled rows, a graph. The graph's nodes are dealt to partitions of equal size
and then exchanged, pair by pair of partitions, so that few edges are cut. A
multinomial logistic classifier learns from each node in which partitions its
neighbours lie. One fifth of the sample's distinct vectors is held out: its
nearest neighbours tell how much probability a query has to cover to meet
``TARGET`` of them.

Every row of the table is then indexed in the partition that the classifier
gives the most probability. A query goes to its most probable partitions, in
order, until the probability covered reaches the fitted share, and is compared
there with every row by exact distances in double precision.

Vectors that are NULL, empty, zero or hold a NULL or non-finite component take
no part; neither do those whose length is not the table's most frequent one (the
shorter at a tie), since distances are between equal lengths. A row is known by
its place in the written index, not by its id: rows that repeat an id or a
vector are all candidates, and a row without an id is a candidate (last at a
tie) but never a query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import text as tx
from barflow.llm import vectors as vc

#: Rows the partitions are fitted on (at most), neighbours of a node, partitions, share of held-out neighbours to meet.
SAMPLE, DEGREE, PARTITIONS, TARGET = 8_192, 10, 16, 0.97


@dataclass(frozen=True)
class Router:
    """Weights of the classifier (components and a constant by partitions) and the probability to cover."""

    weights: np.ndarray
    cover: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[unit(x), np.ones(len(x))] @ self.weights
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def cell(self, x: np.ndarray) -> np.ndarray:
        return self.probabilities(x).argmax(axis=1)

    def before(self, x: np.ndarray) -> np.ndarray:
        """For each partition, the probability of those that come before it (ties: the smaller number first)."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        sorted_p = np.take_along_axis(p, order, 1)
        out = np.empty_like(p)
        np.put_along_axis(out, order, np.cumsum(sorted_p, axis=1) - sorted_p, 1)
        return out

    def probed(self, x: np.ndarray) -> np.ndarray:
        return self.before(x) <= self.cover


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors scaled to a root mean square of one (the classifier sees directions; distances use the originals)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).mean(axis=1, keepdims=True))


def nearest(queries: np.ndarray, rows: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Indices of the ``k`` nearest rows (fewer if there are fewer) of each query but ``own``."""
    k = min(k, len(rows) - (own is not None))
    out = np.empty((len(queries), max(k, 0)), np.int64)
    for lo in range(0, len(queries) if k > 0 else 0, 256):
        q = queries[lo : lo + 256]
        with np.errstate(over="ignore", invalid="ignore"):
            d = np.nan_to_num((rows * rows).sum(axis=1) - 2 * (q @ rows.T), nan=np.inf)
        if own is not None:
            d[np.arange(len(q)), own[lo : lo + 256]] = np.inf
        out[lo : lo + 256] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(neighbours: np.ndarray, parts: int, rounds: int = 40, seed: int = 3) -> np.ndarray:
    """Parts of equal size (up to one) of a neighbour graph that cut few edges.

    Each node names the part that holds most of its neighbours. Two parts then
    exchange nodes that name each other, the largest joint gains first, so sizes
    never change. Early rounds exchange half of them, lest neighbours swap places.
    """
    n, k = neighbours.shape
    part = np.empty(n, np.int64)
    part[np.random.default_rng(seed).permutation(n)] = np.arange(n) * parts // max(n, 1)
    here = np.repeat(np.arange(n), k)
    src, dst = np.concatenate([here, neighbours.ravel()]), np.concatenate([neighbours.ravel(), here])
    for r in range(rounds):
        held = np.bincount(src * parts + part[dst], minlength=n * parts).reshape(n, parts).astype(np.float64)
        own = held[np.arange(n), part]
        held[np.arange(n), part] = -1
        to = held.argmax(axis=1)
        gain = held.max(axis=1) - own
        moved = 0
        for i in range(parts):
            for j in range(i + 1, parts):
                a, b = (x[np.argsort(-gain[x], kind="stable")] for x in (np.flatnonzero((part == i) & (to == j)), np.flatnonzero((part == j) & (to == i))))
                q = min(len(a), len(b))
                q = int((gain[a[:q]] + gain[b[:q]] > 0).sum())
                q = (q + 1) // 2 if r < rounds - 3 else q
                part[a[:q]], part[b[:q]] = j, i
                moved += q
        if not moved:
            break
    return part


def classifier(x: np.ndarray, shares: np.ndarray, steps: int = 300, rate: float = 0.05, shrink: float = 1e-4) -> np.ndarray:
    """Weights of a multinomial logistic regression on soft targets, by full-batch gradient steps with momentum."""
    a = np.c_[unit(x), np.ones(len(x))]
    w = np.zeros((a.shape[1], shares.shape[1]))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = a @ w
        z = np.exp(z - z.max(axis=1, keepdims=True))
        g = a.T @ (z / z.sum(axis=1, keepdims=True) - shares) / len(a) + shrink * w
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return w


def _neighbours(sample: DataFrame, graph: np.ndarray, k: int, slices: int = 16) -> np.ndarray:
    """Nearest sampled rows of every sampled row, found in Spark tasks against the sample (bounded by its size)."""
    spark = sample.sparkSession
    held = spark.sparkContext.broadcast(graph)

    def find(batches):
        for batch in batches:
            at = np.asarray(batch.column(0))
            found = nearest(held.value[at], held.value, k, at)
            yield pa.record_batch([pa.array(at), pa.array(list(found), pa.list_(pa.int64()))], names=["at", "near"])

    got = spark.range(0, len(graph), 1, slices).mapInArrow(find, "at long, near array<long>").toArrow().sort_by("at")
    held.destroy()
    return vc.matrix(got["near"], np.int64)


def fit(rows: DataFrame, vector: str = "embedding", key: str = "rid", parts: int = PARTITIONS, sample: int = SAMPLE, target: float = TARGET) -> Router | None:
    """The router, from at most ``sample`` of the prepared rows; ``None`` if there is no row."""
    picked = rows.select(F.xxhash64(key, F.lit(11)).alias("h"), key, vector).orderBy("h", key).limit(sample).toArrow()
    if not picked.num_rows:
        return None
    x = vc.matrix(picked[vector])
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]  # many copies of one vector must not decide what is covered
    held, kept = x[::5], np.delete(x, np.s_[::5], axis=0)
    if len(kept) < 2 * parts:  # too few to learn from: every query looks everywhere
        return Router(np.zeros((x.shape[1] + 1, 1)), 1.0)
    near = _neighbours(rows, kept, DEGREE)
    part = balanced_parts(near, parts)
    shares = np.bincount(np.repeat(np.arange(len(kept)), near.shape[1]) * parts + part[near.ravel()], minlength=len(kept) * parts).reshape(-1, parts).astype(float)
    shares[np.arange(len(kept)), part] += 3
    found = Router(classifier(kept, shares / shares.sum(axis=1, keepdims=True)), 1.0)
    cells = found.cell(x)[nearest(held, x, DEGREE, np.arange(0, len(x), 5))]
    return Router(found.weights, float(np.quantile(np.take_along_axis(found.before(held), cells, 1), target, method="higher")))


def prepare(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Usable rows as ``rid, vec_id, embedding``, written once so that ``rid`` stays."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    rows = rows.where(vc.finite("embedding") & F.exists("embedding", lambda x: x != 0))
    rows = tx.written(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "embedding"), "ann-rows")
    length = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("embedding") == F.lit(length["n"] if length else 0))


def index(rows: DataFrame, router: Router) -> DataFrame:
    """Every prepared row with its partition ``cell``."""

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                cell = router.cell(vc.matrix(batch.column("embedding")))
                yield batch.append_column("cell", pa.array(cell, pa.int32()))

    kind = rows.schema["embedding"].dataType.simpleString()
    return tx.written(rows.mapInArrow(place, f"rid long, vec_id long, embedding {kind}, cell int"), "ann-index")


def route(queries: DataFrame, router: Router) -> DataFrame:
    """A row for each query and partition it is sent to."""

    def send(batches):
        for batch in batches:
            if batch.num_rows:
                row, cell = np.nonzero(router.probed(vc.matrix(batch.column("embedding"))))
                yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row)).columns, pa.array(cell, pa.int32())], names=["rid", "vec_id", "embedding", "cell"])

    kind = queries.schema["embedding"].dataType.simpleString()
    return queries.select("rid", "vec_id", "embedding").mapInArrow(send, f"rid long, vec_id long, embedding {kind}, cell int")


def _rerank(k: int, schema: str):
    def tile(rows: pa.Table, queries: pa.Table) -> pa.Table:
        got = {c: [] for c in ("qrid", "query_id", "rid", "vec_id", "score")}
        if rows.num_rows and queries.num_rows:
            x, q = vc.matrix(rows["embedding"]), vc.matrix(queries["embedding"])
            rid, vid, no_id = vc.longs(rows["rid"]), vc.longs(rows["vec_id"]), np.asarray(rows["vec_id"].is_null().combine_chunks())
            qrid, qid = vc.longs(queries["rid"]), vc.longs(queries["vec_id"])
            norms = (x * x).sum(axis=1)
            for i in range(len(q)):
                with np.errstate(over="ignore", invalid="ignore"):
                    rough = norms - 2 * (x @ q[i]) + q[i] @ q[i]
                    slack = 1e-9 * (norms + q[i] @ q[i])
                if np.isfinite(rough).all() and len(x) > k + 1:  # all that may be among the k + 1 nearest, rounding and all
                    edge = np.partition(rough + slack, k)[k]
                    at = np.flatnonzero(rough - slack <= edge)
                else:
                    at = np.arange(len(x))
                at = at[rid[at] != qrid[i]]
                gap = x[at] - q[i]
                with np.errstate(over="ignore"):
                    far = np.abs(gap).max(axis=1) if gap.size else np.zeros(len(at))
                    plain = np.sqrt((gap * gap).sum(axis=1))
                    scaled = far * np.sqrt(((gap / np.where(far > 0, far, 1)[:, None]) ** 2).sum(axis=1))
                score = np.where(np.isfinite(plain) & (plain > 1e-150), plain, scaled)
                best = np.lexsort((rid[at], vid[at], no_id[at], score))[:k]
                for c, v in (("qrid", np.full(len(best), qrid[i])), ("query_id", np.full(len(best), qid[i])), ("rid", rid[at][best]), ("score", score[best])):
                    got[c].append(v)
                got["vec_id"].extend(None if no_id[j] else int(vid[j]) for j in at[best])
        return vc.table_of(schema, **{c: v if c == "vec_id" else (np.concatenate(v) if v else []) for c, v in got.items()})

    return tile


def search(indexed: DataFrame, queries: DataFrame, router: Router, k: int = 10, tile_rows: int = vc.TILE_ROWS) -> DataFrame:
    """The ``k`` nearest rows found for each query (rows of the index): ``query_id, rank, vec_id, score``.

    Tiles of a partition's rows and queries give their own ``k`` best, which are
    then ranked for each query: by distance, then id (NULL last), then row.
    """
    from pyspark.sql import Window

    schema = "qrid long, query_id long, rid long, vec_id long, score double"
    found = vc.tiles(indexed, route(queries, router), "cell", "rid", _rerank(k, schema), schema, tile_rows)
    order = Window.partitionBy("qrid").orderBy("score", F.col("vec_id").asc_nulls_last(), "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbours(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, parts: int = PARTITIONS, sample: int = SAMPLE, target: float = TARGET) -> DataFrame:
    """Nearest rows of every row whose id is divisible by ``every``, against the whole table."""
    rows = prepare(df, vec_id, vector)
    router = fit(rows, parts=parts, sample=sample, target=target)
    if router is None:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    indexed = index(rows, router)
    return search(indexed, indexed.where(F.col("vec_id") % every == 0), router, k)
