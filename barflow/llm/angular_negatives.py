"""Hard-negative mining with angular triangle filtering and exact integer scores.

Vectors become integers ``floor(scale * x)``; a row's score for an anchor is
their inner product. Every row stores its norm and its angles to a few reference
directions (rows far apart from each other, chosen from a bounded sample; any
choice gives the same result). Angles obey the triangle inequality, so for a
reference r the angle between anchor and row lies between |a - b| and
min(a + b, 2 pi - a - b), where a and b are their angles to r. The narrowest such
interval over all references gives an interval of cosines and, times both norms
and widened for rounding, bounds of the score.

An anchor's positives are its best rows of the same label: only rows whose upper
bound reaches the fifth largest lower bound are scored. Its negatives lie, for
each positive, in a window of scores below the positive's: only rows of another
label whose bounds overlap a window are scored.

Rows whose label or vector is NULL or whose vector holds a NULL or non-finite
component take no part. Only vectors of one length are compared; a vector of
length 0 has the score 0. Rows are known by their place in the written table, so
rows that repeat an id are rows of their own; a row without an id is never an
anchor and comes last at a tie. Scaled components and scores beyond the range of
a long stay at its ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm import text as tx
from barflow.llm import vectors as vc

#: Reference directions, and the rows they are chosen from (at most).
REFERENCES, SAMPLE = 16, 1_024
#: Angles are widened by this (an arc cosine is off by less than 1e-7 rad) and bounds by this share.
_ANGLE, _SHARE = 1e-6, 1e-9


def moved_label(label: str = "label", vec_id: str = "vec_id") -> Column:
    """The label, moved on by one of ten where the id is divisible by 7."""
    c = F.col(label).cast("long")
    return F.when(F.col(vec_id) % 7 == 0, (c + 1) % 10).otherwise(c)


def directions(rows: DataFrame, n: int, sample: int) -> dict[int, np.ndarray]:
    """For each vector length, up to ``n`` unit vectors that lie far apart, from at most ``sample`` rows in all."""
    some = rows.where(F.exists("v", lambda x: x != 0)).orderBy(F.xxhash64("rid", F.lit(13)), "rid").limit(sample).select("v").collect()
    by: dict[int, list] = {}
    for r in some:
        by.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for length, vectors in by.items():
        x = np.array(vectors, np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        chosen, closest = [0], x @ x[0]
        while len(chosen) < min(n, len(x)):
            chosen.append(int(closest.argmin()))
            closest = np.maximum(closest, x @ x[chosen[-1]])
        out[length] = x[chosen]
    return out


def prepare(df: DataFrame, vec_id: str, vector: str, label: Column, scale: int, references: int, sample: int) -> DataFrame:
    """Usable rows with integers, norm and angles: ``rid, vec_id, label, dim, v, norm, angles``."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("x")).where(vc.finite("x") & F.col("label").isNotNull())
    whole = F.transform("x", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = tx.written(rows.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.size("x").alias("dim"), whole.alias("v")), "negatives-rows")
    refs = directions(rows, references, sample)

    def angles(batches):
        for batch in batches:
            dims, norm, angle = np.asarray(batch.column("dim")), np.zeros(batch.num_rows), [[]] * batch.num_rows
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = vc.matrix(batch.column("v").take(pa.array(at)), np.float64)
                norm[at] = size = np.sqrt((x * x).sum(axis=1))
                if int(dim) in refs:
                    cosine = np.divide(x @ refs[int(dim)].T, size[:, None], out=np.zeros((len(at), len(refs[int(dim)]))), where=size[:, None] > 0)
                    for i, a in zip(at, np.arccos(np.clip(cosine, -1, 1)), strict=True):
                        angle[i] = a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), pa.array(angle, pa.list_(pa.float64()))], names=[*batch.schema.names, "norm", "angles"])

    return tx.written(rows.mapInArrow(angles, "rid long, vec_id long, label long, dim int, v array<long>, norm double, angles array<double>"), "negatives-angles")


def score_bounds(angles: np.ndarray, norms: np.ndarray, angle: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of rows with an anchor."""
    low, high = np.zeros(len(norms)), np.full(len(norms), np.pi)
    for r in range(angles.shape[1]):
        both = angles[:, r] + angle[r]
        np.maximum(low, np.abs(angles[:, r] - angle[r]), out=low)
        np.minimum(high, np.minimum(both, 2 * np.pi - both), out=high)
    size = norms * norm
    slack = size * _SHARE + 1  # a whole unit for the rounding of the score itself
    least, most = np.cos(np.minimum(high + _ANGLE, np.pi)) * size - slack, np.cos(np.maximum(low - _ANGLE, 0)) * size + slack
    return np.clip(least, -(2.0**63), 2.0**63), np.clip(most, -(2.0**63), 2.0**63)  # as the scores


class _Rows:
    """The rows of a tile as arrays."""

    def __init__(self, table: pa.Table):
        self.rid, self.vec_id, self.label = (vc.longs(table[c]) for c in ("rid", "vec_id", "label"))
        self.no_id = np.asarray(table["vec_id"].is_null().combine_chunks()) if table.num_rows else np.zeros(0, bool)
        self.v, self.angles = vc.matrix(table["v"], np.int64), vc.matrix(table["angles"])
        self.norm = np.asarray(table["norm"].combine_chunks()) if table.num_rows else np.zeros(0)

    def ids(self, at: np.ndarray) -> list:
        return [None if n else int(i) for n, i in zip(self.no_id[at], self.vec_id[at], strict=True)]

    def first(self, at: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
        """The first ``k`` places of ``at`` by falling score, id (NULL last) and row."""
        if len(at) > 4 * k:
            edge = np.partition(score, len(score) - k)[len(score) - k]
            some = np.flatnonzero(score >= edge)
            return some[np.lexsort((self.rid[at[some]], self.vec_id[at[some]], self.no_id[at[some]], -score[some]))[:k]]
        return np.lexsort((self.rid[at], self.vec_id[at], self.no_id[at], -score))[:k]


_POSITIVE = "arid long, rid long, vec_id long, score long"
_NEGATIVE = "arid long, prid long, rid long, vec_id long, score long"


def _positives(k: int):
    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        got = {"arid": [], "rid": [], "vec_id": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            x, a = _Rows(rows), _Rows(anchors)
            for i in range(len(a.rid)):
                at = np.flatnonzero((x.label == a.label[i]) & (x.rid != a.rid[i]))
                if not len(at):
                    continue
                low, high = score_bounds(x.angles[at], x.norm[at], a.angles[i], a.norm[i])
                if len(at) > k:  # at least k rows score that much
                    at = at[high >= np.partition(low, len(low) - k)[len(low) - k]]
                score = vc.products(x.v[at], a.v[i])
                best = x.first(at, score, k)
                got["arid"] += [int(a.rid[i])] * len(best)
                got["rid"] += x.rid[at[best]].tolist()
                got["vec_id"] += x.ids(at[best])
                got["score"] += score[best].tolist()
        return vc.table_of(_POSITIVE, **got)

    return tile


def _negatives(k: int, share: int):
    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        got = {"arid": [], "prid": [], "rid": [], "vec_id": [], "score": []}
        if rows.num_rows and anchors.num_rows:
            x, a = _Rows(rows), _Rows(anchors)
            for i, positives in enumerate(anchors["positives"].to_pylist()):
                windows = [(-(-share * p["score"] // 100), p["score"], p["rid"]) for p in positives if p["score"] >= 0]  # below 0 a window is empty
                at = np.flatnonzero(x.label != a.label[i])
                if not windows or not len(at):
                    continue
                low, high = score_bounds(x.angles[at], x.norm[at], a.angles[i], a.norm[i])
                meets = np.zeros(len(at), bool)
                for least, most, _ in windows:
                    meets |= (high >= least) & (low <= most)
                at = at[meets]
                score = vc.products(x.v[at], a.v[i])
                for least, most, prid in windows:
                    inside = np.flatnonzero((score >= least) & (score <= most))
                    best = inside[x.first(at[inside], score[inside], k)]
                    got["arid"] += [int(a.rid[i])] * len(best)
                    got["prid"] += [prid] * len(best)
                    got["rid"] += x.rid[at[best]].tolist()
                    got["vec_id"] += x.ids(at[best])
                    got["score"] += score[best].tolist()
        return vc.table_of(_NEGATIVE, **got)

    return tile


def _ranked(found: DataFrame, *group: str) -> Column:
    return F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid"))


def mine(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None, every: int = 100, scale: int = 256, positives: int = 5,
         negatives: int = 5, share: int = 80, references: int = REFERENCES, sample: int = SAMPLE, tile_rows: int = vc.TILE_ROWS) -> DataFrame:
    """Hard negatives of every anchor (id divisible by ``every``) and positive.

    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``:
    the first ``negatives`` rows of another label whose score is between ``share``
    hundredths of the positive's and the positive's. ``label`` defaults to
    ``moved_label()``.
    """
    rows = prepare(df, vec_id, vector, moved_label(vec_id=vec_id) if label is None else label, scale, references, sample)
    anchors = rows.where(F.col("vec_id") % every == 0)
    found = vc.tiles(rows, anchors, "dim", "rid", _positives(positives), _POSITIVE, tile_rows)
    found = found.withColumn("n", _ranked(found, "arid")).where(F.col("n") <= positives)
    found = tx.written(found.select("arid", "rid", "vec_id", "score"), "negatives-positives")
    own = found.groupBy("arid").agg(F.sort_array(F.collect_list(F.struct("score", "rid"))).alias("positives"))  # a few for each anchor
    asked = tx.written(anchors.join(own, anchors["rid"] == own["arid"]).drop("arid"), "negatives-asked")
    got = vc.tiles(rows, asked, "dim", "rid", _negatives(negatives, share), _NEGATIVE, tile_rows)
    got = got.withColumn("rank", _ranked(got, "arid", "prid")).where(F.col("rank") <= negatives)
    pairs = found.select("arid", F.col("rid").alias("prid"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("rid").alias("arid"), F.col("vec_id").alias("anchor_id"))
    got = got.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(pairs, ["arid", "prid"]).join(named, "arid")
    return got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
