"""Operators on embeddings against brute force."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import types as T

from barflow.llm import angular_negatives as an
from barflow.llm import dimension_lloyd as dl
from barflow.llm import learned_partitions as lp
from barflow.llm import vectors as vc

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("rid", T.StringType()), T.StructField("score", T.StringType())])


def rows_of(n, length=64, seed=1, hot=0.3, labels=4):
    """Random directions around a few centres, a third of them one vector, and rows that take no part."""
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(6, length))
    out = []
    for i in range(n):
        x = centres[0] if rnd.random() < hot else centres[rnd.integers(6)] + rnd.normal(size=length) * 0.7
        out.append((i, [float(v) for v in np.float32(x / np.linalg.norm(x))], int(rnd.integers(labels)) if i % 3 else 1))
    bad = [None, [], [0.0] * length, [None] + [0.1] * (length - 1), [float("nan")] * length, [float("inf")] + [0.1] * (length - 1), [0.5] * (length - 1)]
    out += [(100 * (n + k), v, 1) for k, v in enumerate(bad)]
    out += [(n + 1, out[5][1], None), (out[7][0], out[7][1], 1), (None, out[9][1], 1), (out[0][0], out[0][1], 1)]
    return out


@pytest.fixture
def make(spark):
    def frame(rows, parts=4):
        return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)

    return frame


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def nearest(rows, k):
    """All queries' k nearest by brute force: a list of (query_id, [(score, vec_id)])."""
    kept = [(i, np.array(v, np.float64)) for i, v, _ in rows if usable(v) and any(v) and len(v) == 64]
    out = []
    for a, (i, q) in enumerate(kept):
        if i is not None and i % 100 == 0:
            found = [(float(np.sqrt(((x - q) ** 2).sum())), math.inf if j is None else j) for b, (j, x) in enumerate(kept) if b != a]
            out.append((i, sorted(found)[:k]))
    return out


@pytest.mark.parametrize("n", [7, 900])
def test_learned_partitions_recall_and_exact_scores(make, n):
    rows = rows_of(n)
    got = lp.neighbours(make(rows)).collect()
    want = nearest(rows, 10)
    assert sorted({r["query_id"] for r in got}) == sorted({i for i, _ in want})
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["score"], math.inf if r["vec_id"] is None else r["vec_id"]))
    met = total = 0
    for i in by:
        lists = [w for q, w in want if q == i]
        assert len(by[i]) == sum(len(w) for w in lists)
        if len(lists) == 1:
            found = [(s, v) for _, s, v in sorted(by[i])]
            assert found == sorted(found)
            met, total = met + len({v for _, v in found} & {v for _, v in lists[0]}), total + len(lists[0])
            exact = {v: s for s, v in nearest(rows, 10_000)[[q for q, _ in want].index(i)][1]}
            assert all(abs(s - exact[v]) < 1e-12 for s, v in found if list(exact).count(v) == 1 and v not in (7, 0))
    assert met >= 0.9 * total


def test_learned_partitions_cover_everything_is_exact(make):
    """With all probability to cover, ties and copies come out as in brute force."""
    rows = rows_of(400, hot=0.5)
    unique = [r for r in rows if r[0] is not None and [x[0] for x in rows].count(r[0]) == 1]
    prepared = lp.prepare(make(unique))
    router = lp.fit(prepared)
    assert router.cover < 1
    everywhere = lp.Router(router.weights, 1.0)
    indexed = lp.index(prepared, everywhere)
    got = sorted(tuple(r) for r in lp.search(indexed, indexed.where("vec_id % 100 = 0"), everywhere, 10, tile_rows=32).select("query_id", "rank", "vec_id").collect())
    assert got == sorted((i, n + 1, v) for i, w in nearest(unique, 10) for n, (_, v) in enumerate(w))


def test_learned_partitions_of_nothing(make):
    assert lp.neighbours(make([])).collect() == []
    assert lp.neighbours(make([(100, [0.0, 0.0], 1), (200, None, 1)])).collect() == []
    assert lp.neighbours(make([(100, [1.0, 0.0], 1)])).collect() == []


def test_large_and_tiny_vectors_keep_their_order(make):
    rows = [(100, [3e38, 0.0], 1), (1, [3e38, 3e38], 1), (2, [-3e38, 0.0], 1), (3, [1e-38, 0.0], 1), (200, [1e-38, 1e-38], 1)]
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in lp.neighbours(make(rows)).collect()}
    assert [got[100, k] for k in (1, 2, 3, 4)] == [1, 3, 200, 2] and got[200, 1] == 3


def test_balanced_parts_are_balanced_and_cut_less():
    rnd = np.random.default_rng(2)
    x = np.concatenate([rnd.normal(size=(100, 8)) + 9 * np.eye(8)[k] for k in range(4)])
    near = lp.nearest(x, x, 5, np.arange(400))
    part = lp.balanced_parts(near, 4)
    assert np.bincount(part).tolist() == [100] * 4
    assert (part[:, None] == part[near]).mean() > 0.75  # a random dealing keeps a quarter
    assert lp.balanced_parts(near[:, :0], 4).tolist() == lp.balanced_parts(near[:, :0], 4).tolist()


def floor_int(v, scale):
    return math.floor(int(v) * scale) if abs(v) >= 2**53 else math.floor(v * scale)


def lloyd(rows, k=8, rounds=10, scale=1024, length=64):
    kept = [(i, [floor_int(c, scale) for c in v], v) for i, v, _ in rows if usable(v) and len(v) == length]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[2]))[:k]
    centroids = [r[1] for r in first]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centroids)) for _, v, _ in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(centroids)):
            own = [kept[j][1] for j, (_, c) in enumerate(at) if c == n]
            if own:
                centroids[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return sorted((math.inf if r[0] is None else r[0], c, min(d, 2**63 - 1)) for r, (d, c) in zip(kept, assign(), strict=True)), centroids


@pytest.mark.parametrize("n, columns, block", [(300, 16, 32), (5, 7, 4), (60, 64, 2048)])
def test_lloyd_equals_brute_force(make, n, columns, block):
    rows = rows_of(n, hot=0.4)
    found, centroids = dl.lloyd(make(rows), columns=columns, block_rows=block, rounds=4)
    want, expected = lloyd(rows, rounds=4)
    assert centroids == expected
    assert sorted((math.inf if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()) == want


def test_lloyd_with_components_beyond_a_long(make):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=4) * 10.0 ** (3 * i)], 1) for i in range(12)]
    found, centroids = dl.lloyd(make(rows), length=4, k=3, rounds=3, columns=3, block_rows=4)
    want, expected = lloyd(rows, k=3, rounds=3, length=4)
    assert centroids == expected
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in found.collect()) == want


def test_lloyd_report(make):
    rows = rows_of(80)
    want, centroids = lloyd(rows)
    for r in dl.report(make(rows)).collect():
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centroids[r["cluster"]])).encode()).hexdigest()
        assert r["inertia"] == sum(d for *_, d in want) and r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
    assert dl.report(make([])).collect() == [] and dl.report(make([(1, None, 1)])).collect() == []


def negatives(rows, share=80):
    kept = []
    for row, (i, v, label) in enumerate(rows):
        if label is not None and usable(v):
            kept.append((row, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [floor_int(c, 256) for c in v]))
    out = []
    for row, i, label, v in kept:
        if i is None or i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), math.inf if j is None else j, m, other) for m, j, other, w in kept if m != row and len(w) == len(v)))
        for s, j, _, _ in [x for x in scored if x[3] == label][:5]:
            fit = [x for x in scored if x[3] != label and share * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("n, tile, share, references", [(400, 64, 80, 16), (400, 4096, 20, 2), (3, 4, 80, 16)])
def test_negatives_equal_brute_force(make, n, tile, share, references):
    rows = rows_of(n, hot=0.35)
    got = an.mine(make(rows), share=share, tile_rows=tile, references=references)
    cols = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted(tuple(math.inf if r[c] is None else r[c] for c in cols) for r in got.collect()) == negatives(rows, share)


def test_negatives_of_odd_rows(make):
    assert an.mine(make([])).collect() == [] and an.mine(make([(100, [1.0], None)])).collect() == []
    zero = [(100, [0.0, 0.0], 1), (1, [0.0, 0.0], 1), (2, [0.5, 0.1], 2), (3, [], 2), (200, [], 2), (300, [3e4, 3e4], 1), (4, [3e4, 2e4], 1), (5, [3e4, 1.9e4], 2)]
    got = sorted(tuple(r) for r in an.mine(make(zero)).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == negatives(zero)


def test_score_bounds_hold_and_exclude():
    rnd = np.random.default_rng(4)
    x = rnd.integers(-300, 300, size=(500, 12))
    refs = x[:3] / np.linalg.norm(x[:3], axis=1, keepdims=True)
    norm = np.linalg.norm(x, axis=1)
    angle = np.arccos(np.clip(x @ refs.T / norm[:, None], -1, 1))
    out = 0
    for i in range(0, 500, 25):
        low, high = an.score_bounds(angle, norm, angle[i], norm[i])
        score = x @ x[i]
        assert (low <= score).all() and (score <= high).all()
        out += (high < 0.5 * score[i]).sum()
    assert out > 0


def test_exact_products():
    big = np.array([[2**40, -(2**40)], [3, 4], [2**62, 2**62]])
    assert vc.products(big, np.array([2**30, 1])).tolist() == [2**63 - 1 if 2**70 - 2**40 > 2**63 - 1 else 0, 3 * 2**30 + 4, 2**63 - 1]
    assert vc.products(big[:2], np.array([5, 7])).tolist() == [-(2**41), 43]
