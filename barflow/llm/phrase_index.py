"""Benchmark decontamination by a distributed positional inverted index.

``build_index`` tokenises every whole text and stores the positions of every
term. The index is sharded by document: a *segment* holds some consecutive
documents of one scan task, its sorted terms and, for each term, the ascending
positions at which it stands in the segment. Postings of a document never leave
its segment, so building needs no shuffle and a hot term is split over all
segments. The index is a Parquet table in the shared checkpoint folder.

A query phrase is answered inside each segment: the rarest term's list is
shifted by the term's offset to phrase starts, and the other terms' shifted
lists are intersected with it, rarest first; starts that cross a document edge
go. All windows of a chunk are answered in the same numpy calls. Proximity matches
(all terms within a span, any order) start from the rarest term's positions.

Test items are compiled by Spark tasks into a written table of blocks: distinct
terms, the words of the items as term numbers (a window is a stretch of them, so
overlapping windows take no room of their own) and the owners. A block is cut by
the bytes of these arrays, at most ``BLOCK_ITEM_BYTES`` (a longer item is cut into
overlapping pieces; only one word beyond the bound makes a block beyond it). The
driver and the tasks hold one block of it at a time; each block is one pass over
the index, so any number of items works in bounded memory.

Defined results: NULL and empty texts have no words and match nothing; an item
without words has no windows; repeated items match like one, repeated documents
each get their own rows; only the named columns are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm import text as tx

#: Text bytes in a segment (one longer text is a segment of its own).
SEGMENT_BYTES = 4 << 20
#: Bytes of compiled items that one pass over the index takes (the size bound of what is broadcast).
BLOCK_ITEM_BYTES = 8 << 20
#: Words of an item that are compiled at once; a longer item is cut into pieces that share a window less a word.
PIECE_WORDS = 1 << 16
#: Windows, and positions of their rarest terms, that are intersected in one step.
CHUNK_WINDOWS, CHUNK_POSITIONS = 1 << 14, 1 << 20
#: Words in a window.
WINDOW = 10

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_INDEX_SCHEMA = "segment long, doc_ids array<long>, word_bounds binary, terms binary, term_bounds binary, postings binary, posting_bounds binary"


def item_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text, as the index has them."""
    return _WORD.findall((text or "").encode().translate(bytes(tx.LOWER)))


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Positional index of all texts, written once: a row for each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, (part, data, bounds) in enumerate(tx.joined_blocks(batches, "text", segment_bytes)):
            data = tx.LOWER[data]
            starts, ends, word_bounds = tx.words(data, bounds, tx.ALNUM)
            code, terms = tx.codes(data, starts, ends)
            by_term = np.argsort(code, kind="stable").astype(np.int32)  # positions, ascending within a term
            posting_bounds = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(terms)))]).astype(np.int32)
            term_data, term_bounds = tx.buffers(terms) if len(terms) else (np.empty(0, np.uint8), np.zeros(1, np.int64))
            ids = part.column("doc_id")
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([tx.task_number(number)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.cast(pa.int64())),
                    *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in (word_bounds.astype(np.int32), term_data, term_bounds.astype(np.int32), by_term, posting_bounds)],
                ],
                ["segment", "doc_ids", "word_bounds", "terms", "term_bounds", "postings", "posting_bounds"],
            )

    chosen = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return tx.written(chosen.mapInArrow(run, _INDEX_SCHEMA), "phrase-index")


class Segment:
    """One row of the index, for look-ups by term."""

    def __init__(self, row: dict, wanted: pa.Array):
        arrays = {c: np.frombuffer(row[c], np.int32) for c in ("word_bounds", "term_bounds", "postings", "posting_bounds")}
        self.word_bounds, self.postings, bounds = arrays["word_bounds"], arrays["postings"], arrays["posting_bounds"]
        n = len(bounds) - 1
        terms = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(row["term_bounds"]), pa.py_buffer(row["terms"])])
        at = pc.index_in(wanted, terms).fill_null(-1).to_numpy(zero_copy_only=False)
        self.begin = np.where(at >= 0, bounds[at], 0).astype(np.int64)
        self.count = np.where(at >= 0, bounds[at + 1] - bounds[at], 0) if n else np.zeros(len(wanted), np.int32)
        number = np.full(n, -1, np.int32)
        number[at[at >= 0]] = np.flatnonzero(at >= 0)
        self.term_at = np.empty(len(self.postings), np.int32)
        self.term_at[self.postings] = np.repeat(number, np.diff(bounds))

    def positions(self, term: int) -> np.ndarray:
        return self.postings[self.begin[term] : self.begin[term] + self.count[term]]

    def row_of(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.word_bounds, position, "right") - 1


def _chunks(counts: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of the counts that add up to at most ``limit`` (or are one)."""
    total = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + limit, "right")))
        yield lo, hi
        lo = hi


def phrase_starts(segment: Segment, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the term sequences (rows of one width) stand: row number and position.

    The rarest term's list is shifted to phrase starts and intersected with the other
    terms' shifted lists, rarest first. A position is in a term's list if the term
    stands there, so each intersection is one look-up for each start that is left.
    """
    width = phrases.shape[1]
    order = np.argsort(segment.count[phrases], axis=1, kind="stable")
    rarest = phrases[np.arange(len(phrases)), order[:, 0]]
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for lo, hi in _chunks(segment.count[rarest], CHUNK_POSITIONS):
        n = segment.count[rarest[lo:hi]].astype(np.int64)
        row = np.repeat(np.arange(lo, hi), n)
        within = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        starts = segment.postings[segment.begin[rarest[row]] + within].astype(np.int64) - order[row, 0]
        left = (starts >= 0) & (starts + width <= len(segment.term_at))
        row, starts = row[left], starts[left]
        for j in range(1, width):
            offset = order[row, j]
            left = segment.term_at[starts + offset] == phrases[row, offset]
            row, starts = row[left], starts[left]
        left = starts + width <= segment.word_bounds[segment.row_of(starts) + 1]
        found.append((row[left], starts[left]))
    return np.concatenate([r for r, _ in found]), np.concatenate([x for _, x in found])


def proximity_starts(segment: Segment, terms: np.ndarray, span: int) -> np.ndarray:
    """Starts of ``span``-word stretches of one document that hold every term and begin with one of them."""
    terms = np.unique(terms)
    terms = terms[np.argsort(segment.count[terms], kind="stable")]
    near = segment.positions(terms[0])
    first = np.unique(np.concatenate([segment.positions(t) for t in terms]))
    at = np.searchsorted(near, first)
    held = at < len(near)
    first = first[held][near[at[held]] < first[held] + span]
    for t in terms[1:]:
        if len(first) == 0:
            return first
        listed = segment.positions(t)
        at = np.searchsorted(listed, first)
        held = at < len(listed)
        first = first[held][listed[at[held]] < first[held] + span]
    row = segment.row_of(first)
    stop = segment.word_bounds[row + 1]
    inside = np.ones(len(first), bool)
    for t in terms:  # the next place of each term lies in the same document
        listed = segment.positions(t)
        inside &= listed[np.searchsorted(listed, first)] < stop
    return first[inside]


class Phrases:
    """A bounded block of items: distinct terms, words as term numbers, and for each piece of an item its bounds, window width and id."""

    def __init__(self, row):
        self.terms = pa.Array.from_buffers(pa.binary(), len(row["term_bounds"]) // 4 - 1, [None, pa.py_buffer(bytes(row["term_bounds"])), pa.py_buffer(bytes(row["terms"]))])
        self.codes, self.bounds, self.widths = (np.frombuffer(bytes(row[c]), np.int32) for c in ("codes", "bounds", "widths"))
        self.items = pa.array(row["items"], pa.string())

    def windows(self, held: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows whose terms are all held, in chunks of one width: the owner of each, and rows of term numbers."""
        missing = np.concatenate([[0], np.cumsum(~held[self.codes])])
        owner = np.repeat(np.arange(len(self.widths)), np.diff(self.bounds))
        stop = np.arange(len(owner)) + self.widths[owner]
        at = np.flatnonzero(stop <= self.bounds[owner + 1])
        at = at[missing[stop[at]] == missing[at]]
        for width in np.unique(self.widths[owner[at]]):
            own = at[self.widths[owner[at]] == width]
            for lo in range(0, len(own), CHUNK_WINDOWS):
                part = own[lo : lo + CHUNK_WINDOWS]
                yield owner[part], self.codes[part[:, None] + np.arange(width)]


_BLOCK_SCHEMA = "block long, terms binary, term_bounds binary, codes binary, bounds binary, widths binary, items array<string>"


class _Open:
    """A block that is being filled."""

    def __init__(self):
        self.terms: dict[bytes, int] = {}
        self.codes: list[np.ndarray] = []
        self.widths: list[int] = []
        self.items: list[str] = []
        self.size = 0

    def cost(self, item: str, words: list[bytes]) -> int:
        return 4 * len(words) + sum(len(w) + 4 for w in set(words) if w not in self.terms) + len(item.encode()) + 12

    def add(self, item: str, words: list[bytes], width: int) -> None:
        self.size += self.cost(item, words)
        self.codes.append(np.array([self.terms.setdefault(w, len(self.terms)) for w in words], np.int32))
        self.widths.append(min(width, len(words)))
        self.items.append(item)

    def batch(self, number: int) -> pa.RecordBatch:
        term_bounds = np.concatenate([[0], np.cumsum([len(t) for t in self.terms])])
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in self.codes])])
        arrays = [b"".join(self.terms), *(np.asarray(x, np.int32).tobytes() for x in (term_bounds, np.concatenate(self.codes), bounds, self.widths))]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *[pa.array([x], pa.binary()) for x in arrays], pa.array([self.items], pa.list_(pa.string()))],
            ["block", "terms", "term_bounds", "codes", "bounds", "widths", "items"],
        )


def _pieces(words: list[bytes], width: int, limit: int) -> Iterator[list[bytes]]:
    """The words in pieces of at most ``PIECE_WORDS`` words and about ``limit`` bytes that hold every window once."""
    lo = 0
    while lo < len(words):
        hi, size = lo, 0
        while hi < len(words) and hi - lo < PIECE_WORDS and (size <= limit // 2 or hi - lo < width):
            size += len(words[hi]) + 8
            hi += 1
        yield words[lo:hi]
        if hi == len(words):
            return
        lo = hi - width + 1


def compile_items(items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WINDOW, limit: int = BLOCK_ITEM_BYTES) -> DataFrame:
    """The items as a written table of blocks of at most ``limit`` bytes each, compiled by the tasks."""
    chosen = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = chosen.agg(F.sum(F.octet_length("text") + F.octet_length("item_id") + 64).alias("size")).first()["size"] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number = _Open(), 0
        for batch in batches:
            for item, whole in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
                for words in _pieces(item_words(whole), width, limit):
                    if block.items and block.size + block.cost(item, words) > limit:
                        yield block.batch(tx.task_number(number))
                        block, number = _Open(), number + 1
                    block.add(item, words, width)
        if block.items:
            yield block.batch(tx.task_number(number))

    return tx.written(chosen.distinct().repartition(1 + int(size // max(limit // 2, 1 << 16))).mapInArrow(run, _BLOCK_SCHEMA), "phrase-items")


MATCHES = "segment long, row int, doc_id long, item_id string, start int, end int"


def _ranges(segment: Segment, owner: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of the matched ranges by owner and document: owner, row, start and end from the document's first word."""
    order = np.lexsort((starts, owner))
    owner, starts = owner[order], starts[order]
    row = segment.row_of(starts)
    head = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (row[1:] != row[:-1]) | (starts[1:] > starts[:-1] + widths[owner[1:]])]))
    last = np.concatenate([head[1:] - 1, [len(starts) - 1]])
    owner, row = owner[head], row[head]
    ends = np.minimum(starts[last] + widths[owner], segment.word_bounds[row + 1])
    return owner, row, starts[head] - segment.word_bounds[row], ends - segment.word_bounds[row]


def _search(index: DataFrame, block: dict, find, spread: int) -> DataFrame:
    """Matches of a block of items: merged word ranges by document and item (positions count from the document's first word)."""
    shared = index.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Phrases(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_buffer() for c in ("word_bounds", "terms", "term_bounds", "postings", "posting_bounds")}
                segment = Segment(row, wanted.terms)
                hits = []
                for owner, phrases in wanted.windows(segment.count > 0):
                    which, starts = find(segment, phrases)
                    if len(starts):
                        hits.append((owner[which], starts))
                if not hits:
                    continue
                owner, rows, lo, hi = _ranges(segment, np.concatenate([o for o, _ in hits]), np.concatenate([x for _, x in hits]), wanted.widths + spread)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lo), batch.column("segment")[i].as_py(), np.int64)), pa.array(rows, pa.int32()),
                        batch.column("doc_ids")[i].values.take(pa.array(rows)), wanted.items.take(pa.array(owner)), pa.array(lo, pa.int32()), pa.array(hi, pa.int32()),
                    ],
                    ["segment", "row", "doc_id", "item_id", "start", "end"],
                )

    return index.mapInArrow(run, MATCHES)


def _all_blocks(index: DataFrame, items: DataFrame, item_id: str, text: str, width: int, find, spread: int, limit: int) -> DataFrame:
    blocks = compile_items(items, item_id, text, width, limit)
    found = None
    for (number,) in blocks.select("block").sort("block").collect():  # a number for each block
        part = _search(index, blocks.where(F.col("block") == number).first().asDict(), find, spread)
        found = part if found is None else found.unionByName(part)
    return index.sparkSession.createDataFrame([], MATCHES) if found is None else found


def phrase_matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WINDOW, limit: int = BLOCK_ITEM_BYTES) -> DataFrame:
    """Exact occurrences of the items' windows: merged word ranges ``[start, end)`` by document and item."""
    return _all_blocks(index, items, item_id, text, width, phrase_starts, 0, limit)


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = 5, item_id: str = "item_id", text: str = "text", width: int = WINDOW, limit: int = BLOCK_ITEM_BYTES) -> DataFrame:
    """Stretches of a window's length plus ``slop`` that hold all its distinct words, in any order."""

    def find(segment: Segment, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [proximity_starts(segment, phrase, len(phrase) + slop) for phrase in phrases]
        return np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int64)

    return _all_blocks(index, items, item_id, text, width, find, slop, limit)


def indexed_documents(index: DataFrame) -> DataFrame:
    """A row for each indexed document: segment, row, doc_id."""
    return index.select("segment", F.posexplode("doc_ids").alias("row", "doc_id"))


def word_counts(index: DataFrame) -> DataFrame:
    """segment, row, doc_id, n_words of every indexed document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("doc_ids")[i].values
                n = len(ids)
                counts = np.diff(np.frombuffer(batch.column("word_bounds")[i].as_buffer(), np.int32)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("segment")[i].as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), ids, pa.array(counts)], ["segment", "row", "doc_id", "n_words"])

    return index.select("segment", "doc_ids", "word_bounds").mapInArrow(run, "segment long, row int, doc_id long, n_words long")


def hit_words(matches: DataFrame) -> DataFrame:
    """By document: words inside any match, and the sorted ids of the items that match."""
    by_doc = Window.partitionBy("segment", "row")
    reach = F.max("end").over(by_doc.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(reach, F.lit(0))))
    return matches.withColumn("new", new).groupBy("segment", "row").agg(F.sum("new").cast("long").alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """One row for each document: words, words inside benchmark windows, items found."""
    index = build_index(docs, doc_id, text)
    hits = hit_words(phrase_matches(index, benchmark, width=width))
    joined = word_counts(index).join(hits, ["segment", "row"], "left")
    return joined.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
