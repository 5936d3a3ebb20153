"""Near duplicates and repeated strings against brute force."""

import hashlib
import re

import numpy as np
import pytest

from barflow.llm import graph, parity_join, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    label = {i: i for i, _ in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def got_components(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_components_match_all_pairs(make_docs, texts):
    assert got_components(parity_join.linked_components(make_docs(texts))) == brute_components(texts)


def test_components_with_small_tiles_and_hot_lists(make_docs, texts, monkeypatch):
    monkeypatch.setattr(parity_join, "TILE", 3)
    monkeypatch.setattr(parity_join, "HOT", 3)
    rows = texts + [(400 + k, f"{texts[0][1]} tail{k} of its own") for k in range(30)]
    assert got_components(parity_join.linked_components(make_docs(rows, 2))) == brute_components(rows)


def test_borderline_sizes(make_docs):
    base = [f"w{i}" for i in range(300)]
    rows = [(1000 + n, " ".join(base[:n])) for n in range(4, 300, 3)]  # long chains of contained sets
    assert got_components(parity_join.linked_components(make_docs(rows))) == brute_components(rows)


def test_empty_repeated_and_null_ids(make_docs):
    assert parity_join.linked_components(make_docs([])).count() == 0
    got = parity_join.linked_components(make_docs([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None)]))
    assert sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in got.collect() if r.doc_id is not None) == [(False, 1, 2, 1)] * 2
    assert {(r.n_shingles, r.component_id) for r in got.collect() if r.doc_id is None} == {(2, 1), (0, None)}


def test_rows_without_an_id_meet_their_own_class_only(make_docs):
    docs = make_docs([(None, " ".join(f"w{i}" for i in range(k, k + 40))) for k in range(0, 800, 20)]).select("doc_id", "text")
    sets = parity_join._sets(docs).where("codes is null")
    assert parity_join._class_texts(sets.select("cls"), sets, docs).count() == 40


def _meetings(docs):
    """Pairs of classes that some block code brings together, counted with each code."""
    sets = parity_join._sets(docs.select("doc_id", "text"))
    shared = parity_join._packed(docs, 32, parity_join._frequent(sets)).groupBy("bucket").applyInArrow(parity_join._meet(32), "code long, a long, b long")
    row = shared.where("b is null").groupBy("code").count().selectExpr("sum(count * (count - 1) / 2) pairs").first()
    return shared.where("b is not null").count() + (row.pairs or 0)


@pytest.mark.parametrize("length", [30, 150])
def test_a_common_line_brings_no_texts_together(make_docs, length):
    line = " ".join(f"footer{i}" for i in range(13))
    own = lambda k: " ".join(f"d{k}w{i}" for i in range(length))
    rows = [(k, f"{own(k)} {line}") for k in range(600)]
    assert _meetings(make_docs(rows)) == 0  # with the codes in hash order: a share of all pairs
    near = rows + [(1000 + k, f"{own(k)} other {line}") for k in range(0, 40, 2)]
    got = got_components(parity_join.linked_components(make_docs(near)))
    assert got == brute_components(near)
    assert length == 30 or all(got[k][1] == k - 1000 for k in got if k >= 1000)


def test_the_order_of_codes_decides_no_link(make_docs, texts, monkeypatch):
    for seen, ranked, frequent in ((1, 1 << 19, 2), (2, 60, 2)):
        monkeypatch.setattr(parity_join, "SEEN", seen)
        monkeypatch.setattr(parity_join, "RANKED", ranked)
        monkeypatch.setattr(parity_join, "FREQUENT", frequent)
        assert got_components(parity_join.linked_components(make_docs(texts))) == brute_components(texts)


def test_sketch_distance_bounds_symmetric_difference():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 300))
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[int(n * rng.random()) :], rng.integers(0, 1 << 62, 5).astype(np.uint64)])
        h = np.concatenate([np.unique(a), np.unique(b)])
        bounds = np.array([0, len(np.unique(a)), len(h)])
        raw = [np.frombuffer(x, np.uint64)[None, :] for x in parity_join.dense_sketches(h, bounds).to_pylist()]
        while raw[0].shape[1] != raw[1].shape[1]:
            big = int(raw[1].shape[1] > raw[0].shape[1])
            raw[big] = parity_join._fold(raw[big])
        assert int(np.bitwise_count(raw[0] ^ raw[1]).sum()) <= len(set(a.tolist()) ^ set(b.tolist()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 400), (400, 450), (7, 7)], "a long, b long")
    got = {r.node: r.label for r in graph.components(edges).collect()}
    assert all(got[i] == 0 for i in range(201)) and {got[400], got[450], got[500]} == {400}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, least=50):
    order = sorted((i, (t or "").encode()) for i, t in rows if i is not None)
    seen, out, at = set(), {}, 0
    for i, own in order:
        starts = [p for p in range(len(own) - least + 1) if own[p : p + least] in seen]
        gone = np.zeros(len(own), bool)
        for p in starts:
            gone[p : p + least] = True
        seen |= {own[p : p + least] for p in range(len(own) - least + 1)}
        spans = int(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])).clip(0).sum())
        out[i] = (len(own), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(own, np.uint8)[~gone].tobytes()).hexdigest())
    return out


def got_repeats(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()}


@pytest.mark.parametrize("least", [16, 50, 77])
def test_repeats_match_brute_force(make_docs, texts, least):
    report, kept = suffix_dedup.remove_repeats(make_docs(texts), least, with_kept=True)
    assert got_repeats(report) == brute_repeats(texts, least)
    sha = {r.doc_id: r.kept_sha256 for r in report.collect()}
    assert all(hashlib.sha256(r.kept).hexdigest() == sha[r.doc] for r in kept.collect())


def test_repeats_with_early_settling(make_docs, texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    monkeypatch.setattr(suffix_dedup, "PACK_STRINGS", 4000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_STRINGS", 50)
    monkeypatch.setattr(suffix_dedup, "BROADCAST_BYTES", 0)
    assert got_repeats(suffix_dedup.remove_repeats(make_docs(texts, 5))[0]) == brute_repeats(texts)


def test_repeats_of_odd_tables(make_docs):
    assert suffix_dedup.remove_repeats(make_docs([]))[0].count() == 0
    long = "abcdefghij" * 12
    report = suffix_dedup.remove_repeats(make_docs([(None, long), (5, long), (5, long), (6, long), (7, None)]))[0]
    rows = sorted(((r.doc_id if r.doc_id is not None else 99), r.n_bytes, r.n_removed) for r in report.collect())
    assert rows == [(5, 120, 0), (5, 120, 0), (6, 120, 120), (7, 0, 0), (99, 120, 120)]
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(make_docs([]), 8)


def test_names_depend_on_bytes_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 101, 4000).astype(np.uint8)
    for width in (8, 13, 25, 50):
        name = suffix_dedup.names(data, width)
        by_bytes = {}
        for p in range(len(name)):
            assert by_bytes.setdefault(data[p : p + width].tobytes(), name[p]) == name[p]
        assert len(set(by_bytes.values())) == len(by_bytes)
