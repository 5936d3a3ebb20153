"""Removal of repeated byte strings by distributed prefix doubling.

A byte goes if a string of ``min_bytes`` (T) bytes over it also starts in a
document with a smaller id. Position ranks are 64-bit names: the name of 8 bytes
is their packed value, the name of more is made from the pair of two shorter
ones at an offset that doubles until the width is reached. Two rounds go through
Spark, and a position leaves as soon as its name is unique to one text.

Round one ranks prefixes of T/2 bytes. Any T bytes hold exactly one leftmost
smallest name of T/2 bytes (their *anchor*), which depends on those T bytes
alone, so only anchors are ranked: about one position in T/4. Names are
scattered into buckets as packed arrays and sorted there; anchors whose name is
found in one text only drop out, and with them all strings that they anchor.

Round two ranks the T-byte strings around the anchors that are left by the pair
(name at p, name at p + T/2). Each anchor travels with the bytes around it, at
most 3T/2, and the pairs are sorted within the anchor's bucket. The smallest
document of each string keeps it, the others are hits; the union of the hits is
what goes. Both sides of a scatter first settle what one task can see by itself:
names that are known to be shared, and strings whose smaller document lies in the
same task, are not sent on, so a passage that a third of the documents share
costs each task a few entries.

Equal texts are handled once, by the hash of the text; all but the smallest id
lose everything (from T bytes on). Defined results: NULL and empty texts have no
bytes; a NULL id counts as the largest; rows with the same id do not count
against each other; only the named columns are read. Names of strings are
compared as 128-bit pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import text as tx

#: Anchors in a bucket, on average, in round one and in round two.
BUCKET_ANCHORS, BUCKET_STRINGS = 1_500_000, 120_000
#: Text bytes whose anchors a task packs together in round one and in round two.
PACK_BYTES, PACK_STRINGS = 12 << 20, 2 << 20
#: Texts with one name in one pack from which on the name counts as shared at once.
HOT = 64
#: Hits up to this many bytes are broadcast to the texts; beyond, the texts are shuffled.
BROADCAST_BYTES = 16 << 20
_LAST = (1 << 63) - 1
_A, _B = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)


def names(data: np.ndarray, width: int) -> np.ndarray:
    """Name of the ``width`` bytes (8 at least) from each position on, by pairs at doubling offsets."""
    n = len(data)
    if n < width:
        return np.empty(0, np.uint64)
    padded = np.ascontiguousarray(data)
    rank = np.ndarray(shape=(n - 7,), dtype="<u8", buffer=padded, strides=(1,)).copy()
    have = 8
    while have < width:
        offset = min(have, width - have)
        right = rank[offset:]
        rank = rank[: len(right)] * _A + (right ^ (right >> np.uint64(32))) * _B
        rank ^= rank >> np.uint64(29)
        have += offset
    return tx.mix(rank)


def _leftmost_smallest(values: np.ndarray, window: int) -> np.ndarray:
    """Position of the leftmost smallest value of each ``window`` consecutive ones."""
    place = np.arange(len(values), dtype=np.int32)
    have = 1
    while have < window:
        shift = min(have, window - have)
        n = len(values) - shift
        if n <= 0:
            return np.empty(0, np.int32)
        left, right = values[:n], values[shift:]
        better = right < left
        place = np.where(better, place[shift:], place[:n])
        values = np.where(better, right, left)
        have += shift
    return place


def anchors(data: np.ndarray, bounds: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``min_bytes`` in each document.

    Returns the document, the position of the anchor, the first and last string
    start that it anchors, and the anchor's name.
    """
    none = np.empty(0, np.int64)
    width = -(-min_bytes // 2)
    rank = names(data, width)
    place = _leftmost_smallest(rank, min_bytes - width + 1)
    lengths = np.diff(bounds)
    strings = np.maximum(lengths - min_bytes + 1, 0)
    total = int(strings.sum())
    if not total:
        return none, none, none, none, np.empty(0, np.uint64)
    begin = np.cumsum(strings) - strings
    doc = np.repeat(np.arange(len(lengths)), strings)
    start = np.arange(total) - begin[doc] + bounds[:-1][doc]
    at = place[start]
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])]))
    tail = np.concatenate([head[1:] - 1, [total - 1]])
    return doc[head], at[head].astype(np.int64), start[head], start[tail], rank[at[head]]


def _text_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[list[str], np.ndarray]:
    digests = [hashlib.sha256(data[lo:hi]) for lo, hi in zip(bounds[:-1], bounds[1:])]
    return [d.hexdigest() for d in digests], np.array([int.from_bytes(d.digest()[:8], "big", signed=True) for d in digests], np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, sha, tid`` of every row, written; ``tid`` begins the text's SHA-256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in tx.blocks(batches, "text"):
            sha, tid = _text_hashes(np.ascontiguousarray(data), bounds)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(np.diff(bounds)), pa.array(sha, pa.string()), pa.array(tid)], ["doc_id", "n_bytes", "sha", "tid"])

    return tx.written(docs.mapInArrow(run, "doc_id long, n_bytes long, sha string, tid long"), "repeat-texts")


def _runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.empty(0, np.int64)


def _by_text(tid: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """For each text its values, packed."""
    order = np.argsort(tid, kind="stable")
    tid, values = tid[order], values[order]
    cut = _runs(tid)
    return tid[cut], [x.tobytes() for x in np.split(values, cut[1:])] if len(cut) else []


_RANGE = np.dtype([("start", "<i4"), ("end", "<i4")])


def _ranges(doc: np.ndarray, tid: np.ndarray, start: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """For each (document, text) the byte ranges that its hit strings cover, packed."""
    if not len(doc):
        return doc, tid, []
    order = np.lexsort((start, tid, doc))
    doc, tid, start = doc[order], tid[order], start[order]
    other = (doc[1:] != doc[:-1]) | (tid[1:] != tid[:-1])
    head = np.flatnonzero(np.concatenate([[True], other | (start[1:] > start[:-1] + min_bytes)]))
    out = np.zeros(len(head), _RANGE)
    out["start"] = start[head]
    out["end"] = start[np.concatenate([head[1:] - 1, [len(start) - 1]])] + min_bytes
    doc, tid = doc[head], tid[head]
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (tid[1:] != tid[:-1])]))
    return doc[cut], tid[cut], [x.tobytes() for x in np.split(out, cut[1:])]


def merged_ranges(ranges: np.ndarray) -> np.ndarray:
    """Union of byte ranges (touching ones become one)."""
    ranges = np.sort(ranges, order="start")
    reach = np.maximum.accumulate(ranges["end"])
    head = np.flatnonzero(np.concatenate([[True], ranges["start"][1:] > reach[:-1]]))
    out = np.zeros(len(head), _RANGE)
    out["start"] = ranges["start"][head]
    out["end"] = reach[np.concatenate([head[1:] - 1, [len(ranges) - 1]])]
    return out


def _batch(bucket, tids, counts, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(tids, pa.binary()), pa.array(counts, pa.binary()), pa.array(payload, pa.binary())], ["bucket", "tids", "counts", "names"])


_ROUND_ONE = "bucket int, tids binary, counts binary, names binary"


def _scatter_anchors(docs: DataFrame, min_bytes: int, buckets: int) -> DataFrame:
    """Round one's names by bucket: for each text its count of names, then the names (their upper 32 bits)."""

    def pack(tid: np.ndarray, name: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((tid, name))
        tid, name = tid[order], name[order]
        new = np.concatenate([[True], (name[1:] != name[:-1]) | (tid[1:] != tid[:-1])])
        tid, name = tid[new], name[new]
        head = _runs(name)
        many = np.diff(np.concatenate([head, [len(name)]]))
        rank = np.arange(len(name)) - np.repeat(head, many)
        hot = np.repeat(many >= HOT, many)
        known = hot & (rank >= 2)  # two texts tell the bucket; the others need no answer
        for some, base in ((~known, 0), (known, -1 - buckets)):
            t, k = tid[some], name[some]
            bucket = (k % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((t, bucket))
            t, k, bucket = t[order], (k[order] >> np.uint64(32)).astype(np.uint32), bucket[order]
            cut = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(cut)):
                own_t, own_k = t[cut[b] : cut[b + 1]], k[cut[b] : cut[b + 1]]
                first = _runs(own_t)
                counts = np.diff(np.concatenate([first, [len(own_t)]])).astype(np.uint32)
                yield _batch([base + int(b)], [own_t[first].tobytes()], [counts.tobytes()], [own_k.tobytes()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for _, data, bounds in tx.blocks(batches, "text"):
            doc, _, _, _, name = anchors(data, bounds, min_bytes)
            if len(doc):
                held.append((_text_hashes(np.ascontiguousarray(data), bounds)[1][doc], name))
            size += len(data)
            if size >= PACK_BYTES and held:
                yield from pack(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield from pack(*map(np.concatenate, zip(*held)))

    return docs.select("text").mapInArrow(run, _ROUND_ONE)


def _shared_names(buckets: int):
    """The names of a bucket that are found in two texts or more, by text."""

    def run(group: pa.Table) -> pa.Table:
        number = group.column("bucket")[0].as_py()
        read = lambda c, kind: np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group.column(c)])
        tid = np.repeat(read("tids", np.int64), read("counts", np.uint32))
        name = read("names", np.uint32)
        if number >= 0:
            order = np.argsort(name, kind="stable")
            tid, name = tid[order], name[order]
            head = _runs(name)
            many = np.diff(np.concatenate([head, [len(name)]]))
            low, high = np.minimum.reduceat(tid, head), np.maximum.reduceat(tid, head)
            shared = np.repeat(low != high, many)
            tid, name = tid[shared], name[shared]
        else:
            number += 1 + buckets
        # a name is known again by its bucket and its upper bits
        tids, packed = _by_text(tid, name.astype(np.uint64) << np.uint64(32) | np.uint64(number))
        return pa.table({"tid": pa.array(tids, pa.int64()), "names": pa.array(packed, pa.binary())})

    return run


def _pairs(blob: np.ndarray, at: np.ndarray, count: np.ndarray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Round two's rank pairs of all strings around each anchor; ``at`` is where the anchor's bytes begin in the blob."""
    width = -(-min_bytes // 2)
    rank = names(blob, width)
    own = np.repeat(np.arange(len(at)), count)
    p = at[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    return own, rank[p], rank[p + (min_bytes - width)]


def _hits(first: np.ndarray, second: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Strings (by rank pair) that a smaller document has as well."""
    order = np.lexsort((second, first))
    a, b, d = first[order], second[order], doc[order]
    if not len(a):
        return np.zeros(0, bool)
    head = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    least = np.repeat(np.minimum.reduceat(d, head), np.diff(np.concatenate([head, [len(a)]])))
    out = np.zeros(len(a), bool)
    out[order] = d > least
    return out


_ANCHOR = np.dtype([("doc", "<i8"), ("tid", "<i8"), ("start", "<i4"), ("count", "<i4")])


def _scatter_strings(alive: DataFrame, min_bytes: int, round_one: int, buckets: int) -> DataFrame:
    """Round two: hits that a task can tell alone, and the anchors with their bytes by bucket (round one had ``round_one``)."""

    def pack(data: np.ndarray, bounds: np.ndarray, docs: np.ndarray, tids: np.ndarray, kept: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        doc, at, first, last, name = anchors(data, bounds, min_bytes)
        known = (name >> np.uint64(32) << np.uint64(32)) | name % np.uint64(round_one)
        here = np.zeros(len(doc), bool)
        cut = np.searchsorted(doc, np.arange(len(docs) + 1))
        for i, own in enumerate(kept):
            here[cut[i] : cut[i + 1]] = np.isin(known[cut[i] : cut[i + 1]], own)
        doc, first, last, name = doc[here], first[here], last[here], name[here]
        if not len(doc):
            return
        count = last - first + 1
        own, a, b = _pairs(data, first, count, min_bytes)
        hit = _hits(a, b, docs[doc][own])
        p = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) - bounds[:-1][doc[own]]
        told_docs, told_tids, told = _ranges(docs[doc[own[hit]]], tids[doc[own[hit]]], p[hit], min_bytes)
        if len(told):
            whose = np.stack([told_docs, told_tids], axis=1)
            yield _batch(-1 - (told_tids.view(np.uint64) % np.uint64(buckets)).astype(np.int64), [x.tobytes() for x in whose], [b""] * len(told), told)
        open_ = np.bincount(own[~hit], minlength=len(doc)) > 0
        doc, first, count, name = doc[open_], first[open_], count[open_], name[open_]
        info = np.zeros(len(doc), _ANCHOR)
        info["doc"], info["tid"], info["start"], info["count"] = docs[doc], tids[doc], first - bounds[:-1][doc], count
        bucket = (name % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        info, bucket, first, length = info[order], bucket[order], first[order], (count + min_bytes - 1)[order]
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        for x in np.flatnonzero(np.diff(cut)):
            some = slice(cut[x], cut[x + 1])
            n = length[some]
            place = np.repeat(first[some] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            yield _batch([int(x)], [b""], [info[some].tobytes()], [data[place].tobytes()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in tx.joined_blocks(batches, "text", PACK_STRINGS):
            kept = [np.concatenate([np.frombuffer(x, np.uint64) for x in own]) if own else np.empty(0, np.uint64) for own in part.column("names").to_pylist()]
            docs = part.column("doc").to_numpy()
            yield from pack(data, bounds, docs, part.column("tid").to_numpy(), kept)

    return alive.mapInArrow(run, _ROUND_ONE)


def _settle(min_bytes: int):
    """Hits of one bucket by text: those told already, and those that the rank pairs show."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() < 0:
            whose = np.frombuffer(b"".join(group.column("tids").to_pylist()), np.int64).reshape(-1, 2)
            return pa.table({"doc": pa.array(whose[:, 0]), "tid": pa.array(whose[:, 1]), "ranges": group.column("names")})
        info = np.concatenate([np.frombuffer(x.as_buffer(), _ANCHOR) for x in group.column("counts")])
        blob = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in group.column("names")])
        count = info["count"].astype(np.int64)
        length = count + min_bytes - 1
        own, a, b = _pairs(blob, np.cumsum(length) - length, count, min_bytes)
        hit = _hits(a, b, info["doc"][own])
        p = info["start"][own] + np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
        docs, tids, packed = _ranges(info["doc"][own[hit]], info["tid"][own[hit]], p[hit], min_bytes)
        return pa.table({"doc": pa.array(docs, pa.int64()), "tid": pa.array(tids, pa.int64()), "ranges": pa.array(packed, pa.binary())})

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One packed union of ranges for each row."""
    for batch in batches:
        packed = [merged_ranges(np.frombuffer(b"".join(x), _RANGE)).tobytes() for x in batch.column(batch.schema.get_field_index("ranges")).to_pylist()]
        kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc", "tid")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array(packed, pa.binary())], ["doc", "tid", "ranges"])


def _cut(with_kept: bool):
    """Remove the ranges: counts and digest of what is left, and the bytes themselves if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in tx.blocks(batches, "text"):
            removed, spans, sha, kept = [], [], [], []
            for i, packed in enumerate(part.column(part.schema.get_field_index("ranges")).to_pylist()):
                own, gone = data[bounds[i] : bounds[i + 1]], np.frombuffer(packed, _RANGE)
                left = np.concatenate([[0], gone["end"]]), np.concatenate([gone["start"], [len(own)]])
                rest = b"".join(own[a:b].tobytes() for a, b in zip(*left))
                removed.append(int((gone["end"] - gone["start"]).sum()))
                spans.append(len(gone))
                sha.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_kept else None)
            ids = [part.column(part.schema.get_field_index(c)) for c in ("doc", "tid")]
            yield pa.RecordBatch.from_arrays([*ids, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.binary())], ["doc", "tid", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, min_bytes: int = 50, doc_id: str = "doc_id", text: str = "text", with_kept: bool = False) -> tuple[DataFrame, DataFrame]:
    """Two tables: a report (``doc_id, n_bytes, n_removed, n_spans, kept_sha256``) with a row for each row of ``docs``,
    and the texts that lost bytes without being a copy (``doc``, ``tid`` and, if ``with_kept``, the ``kept`` bytes)."""
    if min_bytes < 16:
        raise ValueError("min_bytes must be 16 or more")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    texts = _texts(docs)
    total = texts.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(32, -(-4 * int(total) // (min_bytes * BUCKET_ANCHORS)))
    shared = _scatter_anchors(docs, min_bytes, buckets).groupBy("bucket").applyInArrow(_shared_names(buckets), "tid long, names binary")
    shared = tx.written(shared, "repeat-names")
    strings = (shared.agg(F.sum(F.octet_length("names"))).first()[0] or 0) // 8
    tx.release()

    # the texts that still have shared names, each under its smallest id
    of_text = shared.groupBy("tid").agg(F.collect_list("names").alias("names"))
    holders = texts.groupBy("tid").agg(F.min("doc_id").alias("holder"))
    wanted = of_text.join(holders, "tid")
    begin = F.conv(F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 8), 16, 10).cast("long")  # rows with one id may differ in text
    alive = docs.join(wanted, docs["doc_id"].eqNullSafe(wanted["holder"])).where(begin == F.shiftrightunsigned("tid", 32))
    alive = tx.written(alive.select(F.coalesce("holder", F.lit(_LAST)).alias("doc"), "tid", "names", "text"), "repeat-alive")
    tx.release()

    deal = max(32, -(-int(strings) // BUCKET_STRINGS))
    found = _scatter_strings(alive, min_bytes, buckets, deal).groupBy("bucket").applyInArrow(_settle(min_bytes), "doc long, tid long, ranges binary")
    hits = found.groupBy("doc", "tid").agg(F.collect_list("ranges").alias("ranges")).mapInArrow(_merge, "doc long, tid long, ranges binary")
    hits = tx.written(hits, "repeat-hits")
    tx.release()
    size = hits.agg(F.sum(F.octet_length("ranges") + 16)).first()[0] or 0
    small = F.broadcast(hits) if size <= BROADCAST_BYTES else hits  # else the texts are shuffled to their hits
    cut = alive.select("doc", "tid", "text").join(small, ["doc", "tid"]).mapInArrow(_cut(with_kept), "doc long, tid long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    cut = tx.written(cut.dropDuplicates(["doc", "tid"]) if with_kept else cut.drop("kept").distinct(), "repeat-cut")

    rows = texts.join(holders, "tid").join(cut.drop("doc", "kept"), "tid", "left")
    copy = (F.coalesce("doc_id", F.lit(_LAST)) > F.coalesce("holder", F.lit(_LAST))) & (F.col("n_bytes") >= min_bytes)
    own = F.col("doc_id").eqNullSafe(F.col("holder")) & F.col("n_removed").isNotNull()
    report = rows.select(
        "doc_id", "n_bytes",
        F.when(copy, F.col("n_bytes")).when(own, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, F.lit(1)).when(own, F.col("n_spans")).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(""), 256)).when(own, F.col("kept_sha256")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    return report, cut
