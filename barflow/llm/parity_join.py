r"""N-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct 5-word shingles (words
``[^\x20\x09-\x0D]+`` of the lower-cased whole text; fewer words are one
shingle). Two sets link when ``100 * |A & B| >= 75 * |A | B|``. With ``a <= b``
shingles that bounds the sizes (``3 b <= 4 a``) and the symmetric difference
(``D <= (a + b) / 7``).

Sketches. Every shingle flips one bit of a very wide bit sketch that is cut into
K blocks; what is left is the parity of each bit. A block is known by the XOR of
its flipped bits' codes. A pair within D differs in D blocks at most, so it
agrees in the others (pigeonhole). Let ``s`` be the blocks of A that are not
empty: the pair shares at least ``s - D`` of them, so A's D + 1 first block
codes and B's meet in one at least, in any order that both keep. The order is
rarest first: codes are counted over all classes, frequent ones (a line that many
texts share) come last by the octave of their count, so texts that have little
else in common do not meet. The counts decide the work only, never the links:
tasks count whole packs of text and report the codes of ``SEEN`` classes or more,
and the most frequent ``RANKED`` codes at most are given to the tasks.
K depends on the size band of the smaller document, an octave; a document takes
part in the band below its own too if a partner can be there. In small bands
every shingle is a block. A document with D filled blocks or fewer (rare) also
gets a mark that it shares with all such documents of its band.

A dense sketch of 2 bits or more a shingle goes with every set: the Hamming
distance of two never exceeds the symmetric difference, which filters candidate
pairs; larger sketches fold to smaller ones by XOR of their halves.

Candidates. Equal sets are one class from the start. Block codes are scattered
into memory-sized buckets as packed arrays. A code that two classes share gives
that pair; one that more share gives a star, never all pairs: each class with the
pivot, the class that meets most others over all codes (in a group of copies,
their origin). Codes with the same classes count once. What the sketches allow is
verified on the exact sets and joined into components. Codes whose classes still
lie in different components are looked at again: their classes are compared
sketch against sketch in tiles of bounded size, and pairs of different components
that pass are verified too. So no link between different texts is lost, and a
large group of copies costs a star. A code that is frequent within one task
travels in lists of its own, spread over the buckets.

Sets are known by a 64-bit hash (two different sets share one with probability
2^-64). Defined results: NULL, empty and wordless texts have no shingles and
link with nothing; repeated rows are members of one class; only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import graph
from barflow.llm import text as tx

#: Words in a shingle; percent of the union that must be common.
WIDTH, PERCENT = 5, 75
#: Block codes in a bucket, on average.
BUCKET_CODES = 1_500_000
#: Text bytes whose codes a task packs together.
PACK_BYTES = 12 << 20
#: Classes of one code in one pack from which on they travel as a list.
HOT = 256
#: Classes in a tile of sketch comparisons.
TILE = 2048
#: Classes of one pack from which on a code's count is reported; codes that the common order may list (16 bytes each).
SEEN, RANKED = 4, 1 << 19
#: Classes from which on a code counts as frequent.
FREQUENT = 32
_LISTED = np.int64(-(1 << 63))  # in a bucket: the code also has a list elsewhere
_SMALL = 64  # below, every shingle is a block of its own

_C = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89, 0x452821E638D01377)]


def shingle_sets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted within it, and where each document's begin (n + 1)."""
    n = len(bounds) - 1
    starts, ends, word_bounds = tx.words(tx.LOWER[data], bounds, tx.VISIBLE)
    units = tx.piece_hashes(tx.LOWER[data], starts, ends)
    own = tx.owners(word_bounds)
    h = tx.window_hashes(units, WIDTH)
    whole = own[: len(h)] == own[WIDTH - 1 :] if len(h) else np.zeros(0, bool)
    h, doc = h[whole], own[: len(h)][whole]
    count = np.diff(word_bounds)
    short = np.flatnonzero((count > 0) & (count < WIDTH))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for j in range(WIDTH - 1):
            more = count[short] > j
            value[more] = tx.mix(value[more] * np.uint64(31) + units[word_bounds[short[more]] + j] + np.uint64(j + 1))
        h, doc = np.concatenate([h, value]), np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
        h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(n + 1))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def set_hash(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    return tx.mix(_sums(tx.mix(h ^ _C[0]), bounds) ^ tx.mix(_sums(tx.mix(h ^ _C[1]), bounds))).view(np.int64)


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the dense sketch: the power of two from twice the set's size, 64 at least."""
    return np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(2 * n, 2))).astype(np.int64))


def dense_sketches(h: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Parity of the set's shingles at each of the sketch's bits, as bytes."""
    size = sketch_bits(np.diff(bounds))
    ends = np.cumsum(size)
    own = tx.owners(bounds)
    at = (tx.mix(h ^ _C[2]) & (size[own] - 1).astype(np.uint64)).astype(np.int64) + (ends - size)[own]
    parity = (np.bincount(at, minlength=int(ends[-1]) if len(ends) else 0) & 1).astype(np.uint8)
    raw = np.packbits(parity, bitorder="little")
    offsets = np.concatenate([[0], ends // 8]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _band_codes(h: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """All block codes of each document, for its own band and the one below: document indices, their bounds D and marks; then an index into those and a code for each filled block."""
    n = np.diff(bounds)
    band = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
    lower = np.floor(np.log2(np.maximum(-(-3 * n // 4), 1))).astype(np.int64)
    for below in (0, 1):
        chosen = np.flatnonzero((n > 0) & (lower < band)) if below else np.flatnonzero(n > 0)
        if not len(chosen):
            continue
        size, j = n[chosen], band[chosen] - below
        top = (np.int64(1) << (j + 1)) - 1  # the largest smaller document of the band
        bound = (size + top) // 7 if below else (size + 4 * size // 3) // 7
        blocks = (top + 4 * top // 3) // 7 * 3 // 2 + 3
        lengths = size
        place = np.repeat(bounds[:-1][chosen] - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
        own = np.repeat(np.arange(len(chosen)), lengths)
        own_h, salt = h[place], tx.mix(j.astype(np.uint64) + _C[3])
        small = (top < _SMALL)[own]
        # every shingle a block
        doc = [own[small]]
        code = [tx.mix(own_h[small] ^ salt[own[small]])]
        # K blocks, each the XOR of the codes of its shingles' bits
        wide_own, wide_h = own[~small], own_h[~small]
        if len(wide_own):
            draw = tx.mix(wide_h ^ salt[wide_own])
            block = ((draw >> np.uint64(32)) * blocks[wide_own].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(blocks)])[:-1]
            slot = first[wide_own] + block
            order = np.argsort(slot, kind="stable")
            slot, bits = slot[order], tx.mix(wide_h ^ _C[4])[order]
            head = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            parity = np.bitwise_xor.reduceat(bits, head)
            own_block = wide_own[order][head]
            doc.append(own_block)
            code.append(tx.mix(parity ^ tx.mix((slot[head] - first[own_block]).astype(np.uint64) + salt[own_block])))
        yield chosen, bound, tx.mix(salt ^ _C[0]), np.concatenate(doc), np.concatenate(code)


#: The common order: frequent codes, ascending, and the octave of each one's count.
Order = tuple[np.ndarray, np.ndarray]


def block_codes(h: np.ndarray, bounds: np.ndarray, frequent: Order | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The block codes that each document is looked up by, the rarest D + 1: document index and code."""
    docs, codes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for chosen, bound, mark, doc, code in _band_codes(h, bounds):
        octave = np.zeros(len(code), np.uint8)
        if frequent is not None and len(frequent[0]):
            at = np.minimum(np.searchsorted(frequent[0], code), len(frequent[0]) - 1)
            octave = np.where(frequent[0][at] == code, frequent[1][at], 0)
        order = np.lexsort((code, octave, doc))
        doc, code = doc[order], code[order]
        begin = np.searchsorted(doc, np.arange(len(chosen) + 1))
        kept = np.arange(len(doc)) - begin[doc] <= bound[doc]
        thin = np.flatnonzero(np.diff(begin) <= bound)
        docs += [chosen[doc[kept]], chosen[thin]]
        codes += [code[kept], mark[thin]]
    return np.concatenate(docs), np.concatenate(codes)


def _counted(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of ``SEEN`` classes or more of a pack, and how many; ``held`` has (class, code) arrays."""
    sets, codes = map(np.concatenate, zip(*held))
    order = np.lexsort((sets, codes))
    sets, codes = sets[order], codes[order]
    once = np.concatenate([[True], (codes[1:] != codes[:-1]) | (sets[1:] != sets[:-1])])
    codes, many = np.unique(codes[once], return_counts=True)
    return codes[many >= SEEN], many[many >= SEEN]


def _sets(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, n, cls, sketch, codes, counts`` of every row, written; ``cls`` is the set's hash (NULL without shingles).

    Rows with ``codes`` are no documents: they hold a pack's frequent block codes and their counts (``_frequent`` adds them up).
    """
    columns = "doc_id long, text_hash long, n long, cls long, sketch binary, codes binary, counts binary"
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_hash", "n", "cls")] + [(c, pa.binary()) for c in ("sketch", "codes", "counts")])

    def pack(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        codes, many = _counted(held)
        if len(codes):
            none = [pa.nulls(1, f.type) for f in schema][:5]
            yield pa.RecordBatch.from_arrays([*none, pa.array([codes.tobytes()], pa.binary()), pa.array([many.astype(np.int64).tobytes()], pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for part, data, bounds in tx.blocks(batches, "text"):
            h, own = shingle_sets(data, bounds)
            n, sets = np.diff(own), set_hash(h, own)
            for chosen, _, _, doc, code in _band_codes(h, own):
                held.append((sets[chosen[doc]], code))
            named = [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays([*named, pa.array(n.astype(np.int64)), pa.array(sets, mask=n == 0), dense_sketches(h, own), pa.nulls(len(n), pa.binary()), pa.nulls(len(n), pa.binary())], schema=schema)
            size += len(data)
            if size >= PACK_BYTES and held:
                yield from pack(held)
                held, size = [], 0
        if held:
            yield from pack(held)

    return tx.written(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, columns), "jaccard-sets")


def _frequent(sets: DataFrame) -> Order:
    """The most frequent block codes over all packs (whole octaves of the count, ``RANKED`` codes at most) and their octaves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, counts in zip(batch.column("codes"), batch.column("counts")):
                own = [pa.array(np.frombuffer(x.as_buffer(), np.int64)) for x in (codes, counts)]
                yield pa.RecordBatch.from_arrays(own, ["code", "many"])

    listed = sets.where("codes is not null").select("codes", "counts").mapInArrow(run, "code long, many long")
    totals = listed.groupBy("code").agg(F.sum("many").alias("many")).where(F.col("many") >= FREQUENT)
    totals = tx.written(totals.select("code", F.floor(F.log2("many")).cast("int").alias("octave")), "jaccard-frequent")
    least, held = 64, 0
    for octave, codes in sorted(totals.groupBy("octave").count().collect(), reverse=True):
        held += codes
        if held > RANKED:
            break
        least = octave
    chosen = totals.where(F.col("octave") >= least).toArrow()
    codes, octaves = chosen.column("code").to_numpy().view(np.uint64), chosen.column("octave").to_numpy().astype(np.uint8)
    order = np.argsort(codes)
    return codes[order], octaves[order]


def _packed(docs: DataFrame, buckets: int, frequent: Order) -> DataFrame:
    """Block codes of every row, packed: ``bucket, codes, sets`` (hot codes as lists in buckets below zero)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # 9 bytes for each of at most RANKED codes

    def pack(codes: np.ndarray, sets: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((sets, codes))
        codes, sets = codes[order], sets[order]
        new = np.concatenate([[True], (codes[1:] != codes[:-1]) | (sets[1:] != sets[:-1])])
        codes, sets = codes[new], sets[new]
        head = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
        many = np.diff(np.concatenate([head, [len(codes)]]))
        rows: list[tuple[int, bytes, bytes]] = []
        for k in np.flatnonzero(many >= HOT):
            own = sets[head[k] : head[k] + many[k]]
            spread = -1 - int(tx.mix(own[:1].view(np.uint64) ^ codes[head[k] : head[k] + 1])[0] % np.uint64(buckets))
            rows.append((spread, codes[head[k] : head[k] + 1].tobytes(), own.tobytes()))
        first = np.zeros(len(codes), bool)
        first[head] = True
        sent = first | np.repeat(many < HOT, many)
        listed = codes[head[many >= HOT]]  # their buckets are told that there is a list
        codes, sets = np.concatenate([codes[sent], listed]), np.concatenate([sets[sent], np.full(len(listed), _LISTED)])
        bucket = (codes % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        codes, sets, bucket = codes[order], sets[order], bucket[order]
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)):
            own = slice(cut[b], cut[b + 1])
            rows.append((int(b), (codes[own] // np.uint64(buckets)).astype(np.uint32).tobytes(), sets[own].tobytes()))
        for lo in range(0, len(rows), 64):
            some = rows[lo : lo + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int32()), pa.array([r[1] for r in some], pa.binary()), pa.array([r[2] for r in some], pa.binary())], ["bucket", "codes", "sets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for _, data, bounds in tx.blocks(batches, "text"):
            h, own = shingle_sets(data, bounds)
            doc, code = block_codes(h, own, shared.value)
            if len(doc):
                held.append((code, set_hash(h, own)[doc]))
            size += len(data)
            if size >= PACK_BYTES and held:
                yield from pack(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield from pack(*map(np.concatenate, zip(*held)))

    return docs.select("text").mapInArrow(run, "bucket int, codes binary, sets binary")


def _meet(buckets: int):
    """The classes that share a code: a pair ``a, b``, or from three classes on the members ``code, a``."""

    def run(group: pa.Table) -> pa.Table:
        number = group.column("bucket")[0].as_py()
        pairs, code, own = np.empty((2, 0), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        if number < 0:  # lists of hot codes
            members = []
            for c, x in zip(group.column("codes").to_pylist(), group.column("sets").to_pylist()):
                c, x = np.frombuffer(c, np.uint64), np.frombuffer(x, np.int64)
                c = (c % np.uint64(buckets)) << np.uint64(32) | (c // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)
                members.append((np.repeat(c.view(np.int64), len(x)), x))
            code, own = map(np.concatenate, zip(*members))
        else:
            code = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in group.column("codes")])
            own = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in group.column("sets")])
            order = np.argsort(code, kind="stable")
            code, own = code[order], own[order]
            same = code[1:] == code[:-1]
            shared = np.zeros(len(code), bool)
            shared[1:] |= same
            shared[:-1] |= same
            code, own = code[shared], own[shared]
            order = np.lexsort((own, code))
            code, own = code[order], own[order]
            if len(code):
                new = np.concatenate([[True], (code[1:] != code[:-1]) | (own[1:] != own[:-1])])
                code, own = code[new], own[new]
                at = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
                many = np.diff(np.concatenate([at, [len(code)]]))
                listed = own[at] == _LISTED
                two = at[(many == 2) & ~listed]
                pairs = np.unique(np.stack([own[two], own[two + 1]]), axis=1)
                kept = np.repeat((many > 2) | listed, many) & (own != _LISTED)
                code, own = np.int64(number) << np.int64(32) | code[kept].astype(np.int64), own[kept]
        n, m = pairs.shape[1], len(code)
        return pa.table(
            {
                "code": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(code, pa.int64())]),
                "a": pa.array(np.concatenate([pairs[0], own]), pa.int64()),
                "b": pa.concat_arrays([pa.array(pairs[1], pa.int64()), pa.nulls(m, pa.int64())]),
            }
        )

    return run


def _groups(shared: DataFrame) -> DataFrame:
    """``code, a`` of the codes that three or more classes share, written; of codes with the same classes one is kept."""
    members = shared.where("b is null").select("code", "a").distinct()
    known = members.groupBy("code").agg(F.count(F.lit(1)).alias("many"), F.sum(F.xxhash64("a").cast("decimal(20,0)")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "a")).alias("y"))
    chosen = known.where("many > 1").groupBy("many", "x", "y").agg(F.min("code").alias("code")).select("code", "many")
    return tx.written(members.join(chosen, "code"), "jaccard-groups")


def _stars(groups: DataFrame) -> DataFrame:
    """Each member of a code with the code's pivot: the class that meets most others (a copy's origin, in a group of copies)."""
    meets = groups.groupBy("a").agg(F.sum("many").alias("meets"))
    ranked = groups.join(meets, "a").select("code", "a", F.struct("meets", "a").alias("rank"))
    pivot = ranked.groupBy("code").agg(F.max("rank")["a"].alias("p"))
    pairs = groups.join(pivot, "code").where("a <> p")
    return pairs.select(F.least("a", "p").alias("a"), F.greatest("a", "p").alias("b")).distinct()


def _fold(sketch: np.ndarray) -> np.ndarray:
    half = sketch.shape[1] // 2
    return sketch[:, :half] ^ sketch[:, half:]


def _possible(na: np.ndarray, nb: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Whether sizes and the sketches' Hamming distance allow a link."""
    return (3 * np.maximum(na, nb) <= 4 * np.minimum(na, nb)) & (7 * distance <= na + nb)


def _allowed(na: np.ndarray, nb: np.ndarray, sa: pa.Array, sb: pa.Array) -> np.ndarray:
    """Which pairs of sets (sizes and dense sketches, side by side) may link."""
    ok = 3 * np.maximum(na, nb) <= 4 * np.minimum(na, nb)
    ma, mb = sketch_bits(na), sketch_bits(nb)
    for x, y in {(int(p), int(q)) for p, q in zip(ma[ok], mb[ok])}:
        at = np.flatnonzero(ok & (ma == x) & (mb == y))
        for lo in range(0, len(at), 4096):
            some = at[lo : lo + 4096]
            a, b = (np.frombuffer(b"".join(s.take(pa.array(some)).to_pylist()), np.uint64).reshape(len(some), -1) for s in (sa, sb))
            a, b = (_fold(a) if x > y else a), (_fold(b) if y > x else b)
            ok[some] = _possible(na[some], nb[some], np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64))
    return ok


def _sketch_filter(pairs: DataFrame) -> DataFrame:
    """Pairs ``a, b`` (with ``n`` and ``sketch`` of both) that the sketches allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {f: batch.column(batch.schema.get_field_index(f)) for f in batch.schema.names}
            ok = pa.array(_allowed(c["na"].to_numpy().astype(np.int64), c["nb"].to_numpy().astype(np.int64), c["sa"], c["sb"]))
            yield pa.RecordBatch.from_arrays([c["a"].filter(ok), c["b"].filter(ok)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def _class_texts(need: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``cls, text`` of one text (and its copies of the same id) for each needed class."""
    holder = sets.join(need, "cls").groupBy("cls").agg(F.min_by("text_hash", F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("holder_hash"), F.min("doc_id").alias("holder"))
    # by the text too: rows without an id would all meet each other
    return docs.join(holder, docs["doc_id"].eqNullSafe(holder["holder"]) & (F.xxhash64(docs["text"]) == holder["holder_hash"])).select("cls", "text")


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs of classes whose exact sets link, written."""
    need = tx.written(pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "cls"), "jaccard-need")
    texts = _class_texts(need, sets, docs)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in tx.blocks(batches, "text"):
            h, own = shingle_sets(data, bounds)
            cls = part.column(part.schema.get_field_index("cls"))
            offsets = pa.py_buffer((own * 8).astype(np.int32))
            shingles = pa.Array.from_buffers(pa.binary(), len(own) - 1, [None, offsets, pa.py_buffer(h.tobytes())])
            right = pa.array(set_hash(h, own) == cls.to_numpy())  # should two texts of one id share a hash
            yield pa.RecordBatch.from_arrays([cls.filter(right), shingles.filter(right)], ["cls", "shingles"])

    whole = tx.written(texts.mapInArrow(exact, "cls long, shingles binary").dropDuplicates(["cls"]), "jaccard-exact")
    both = pairs.join(whole.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a").join(whole.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {f: batch.column(batch.schema.get_field_index(f)) for f in batch.schema.names}
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = np.frombuffer(c["sa"][i].as_buffer(), np.uint64), np.frombuffer(c["sb"][i].as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * common >= PERCENT * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([c["a"].filter(pa.array(ok)), c["b"].filter(pa.array(ok))], ["a", "b"])

    return tx.written(both.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long"), "jaccard-links")


def _with_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    side = lambda c: classes.select(F.col("cls").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")


def _near_in_group(ids, label, n, left, raw) -> np.ndarray:
    """Pairs of one tile (``left`` None) or of two tiles against each other, by the matrix of their sketches."""
    bits = sketch_bits(n)
    by_bits = {}
    for m in np.unique(bits):
        at = np.flatnonzero(bits == m)
        by_bits[int(m)] = at, np.frombuffer(b"".join(raw.take(pa.array(at)).to_pylist()), np.uint64).reshape(len(at), -1)
    found = [np.empty((2, 0), np.int64)]
    for m, (at, own) in by_bits.items():
        for other in (m, 2 * m):  # sizes of linked sets differ by a third at most, their sketches by one doubling
            if other not in by_bits:
                continue
            there, sketches = by_bits[other]
            sketches = sketches if other == m else _fold(sketches)
            for lo in range(0, len(at), 64):
                i = at[lo : lo + 64]
                distance = np.zeros((len(i), len(there)), np.int64)
                for word in range(own.shape[1]):
                    distance += np.bitwise_count(own[lo : lo + 64, word][:, None] ^ sketches[:, word][None, :])
                ok = _possible(n[i][:, None], n[there][None, :], distance) & (label[i][:, None] != label[there][None, :])
                if left is not None:
                    ok &= left[i][:, None] != left[there][None, :]
                x, y = np.nonzero(ok)
                found.append(np.stack([ids[i[x]], ids[there[y]]]))
    return np.concatenate(found, axis=1)


def _compare(table: pa.Table) -> pa.Table:
    """Pairs of different components that the sketches allow, in all tiles of one deal."""
    table = table.sort_by([("code", "ascending"), ("lo", "ascending"), ("hi", "ascending")])
    read = lambda c: table.column(c).to_numpy()
    ids, label, n, code, lo, hi = read("a"), read("label"), read("n").astype(np.int64), read("code"), read("lo"), read("hi")
    left = table.column("left").to_numpy()
    raw = table.column("sketch").combine_chunks()
    cut = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
    ends = np.concatenate([cut[1:], [len(code)]])
    alone = lo[cut] == hi[cut]
    small = alone & (ends - cut <= 64)
    found = []
    # small groups all at once: neighbours at growing distance within a group
    group = np.repeat(np.where(small, np.arange(len(cut)), -1), ends - cut)
    for d in range(1, int((ends - cut)[small].max(initial=0))):
        i = np.flatnonzero((group[d:] == group[:-d]) & (group[d:] >= 0) & (label[d:] != label[:-d]))
        if len(i):
            a, b = np.minimum(ids[i], ids[i + d]), np.maximum(ids[i], ids[i + d])
            order = np.lexsort((b, a))  # a pair that several codes share is compared once
            once = order[np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])]
            a, b, i, j = a[once], b[once], i[once], i[once] + d
            ok = _allowed(n[i], n[j], raw.take(pa.array(i)), raw.take(pa.array(j)))
            found.append(np.stack([a, b])[:, ok])
    for k in np.flatnonzero(~small):
        own = slice(cut[k], ends[k])
        found.append(_near_in_group(ids[own], label[own], n[own], None if alone[k] else left[own], raw.slice(cut[k], ends[k] - cut[k])))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    pairs = np.unique(np.sort(pairs, axis=0), axis=1)
    return pa.table({"a": pa.array(pairs[0], pa.int64()), "b": pa.array(pairs[1], pa.int64())})


def _tiled(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of classes of one code, in different components, that the sketches allow; compared in tiles.

    ``members`` has ``code, a, label``. The members of a code are dealt into
    tiles by hash, each tile meets each other once, so a group of any size is
    spread over tasks of bounded size.
    """
    sizes = members.groupBy("code").agg(F.count(F.lit(1)).alias("many"))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("many") / TILE)).cast("int")
    dealt = members.join(sizes, "code").withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("a"), F.col("tiles")).cast("int"))
    meet = dealt.select("code", "a", "label", "tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
    meet = meet.select("code", "a", "label", (F.col("tile") <= F.col("other")).cast("int").alias("left"), F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"))
    meet = tx.written(meet, "jaccard-tiles")
    deals = max(8, -(-meet.count() // (16 * TILE)))  # a pair that several codes of a deal share is told once
    deal = F.pmod(F.xxhash64("code", "lo", "hi"), F.lit(deals)).alias("deal")
    rows = meet.join(classes.select(F.col("cls").alias("a"), "n", "sketch"), "a").select(deal, "code", "lo", "hi", "left", "a", "label", "n", "sketch")
    return rows.groupBy("deal").applyInArrow(_compare, "a long, b long").distinct()


def linked_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; the component is the smallest id reachable by links."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    counted = _sets(docs)
    frequent = _frequent(counted)
    sets = counted.where("codes is null").drop("codes", "counts")
    classes = tx.written(sets.where("cls is not null").groupBy("cls").agg(F.max("n").alias("n"), F.max("sketch").alias("sketch")), "jaccard-classes")
    shingles = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(32, -(-int(shingles) // (2 * BUCKET_CODES)))
    shared = tx.written(_packed(docs, buckets, frequent).groupBy("bucket").applyInArrow(_meet(buckets), "code long, a long, b long"), "jaccard-shared")
    groups = _groups(shared)
    tx.release()

    pairs = shared.where("b is not null").select("a", "b").unionByName(_stars(groups)).distinct()
    near = tx.written(_sketch_filter(_with_sketches(pairs, classes)), "jaccard-near")
    links = _verified(near, sets, docs)
    found = tx.written(graph.components(links), "jaccard-labels")
    tx.release()

    members = groups.join(found.withColumnRenamed("node", "a"), "a", "left").select("code", "a", F.coalesce("label", "a").alias("label"))
    members = tx.written(members, "jaccard-members")
    mixed = members.groupBy("code").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("code")
    more = _tiled(members.join(mixed, "code"), classes)
    more = tx.written(more.join(near, ["a", "b"], "left_anti"), "jaccard-more")
    if not more.isEmpty():
        links = links.unionByName(_verified(more, sets, docs))
        found = tx.written(graph.components(links), "jaccard-labels")

    named = sets.join(found.withColumnRenamed("node", "cls"), "cls", "left").select("doc_id", "n", F.coalesce("label", "cls").alias("label"))
    named = tx.written(named, "jaccard-named")
    smallest = named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "label", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"))
