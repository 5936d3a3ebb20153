"""Vectorised text helpers shared by the operators of this subpackage.

Spark hands text to Python as Arrow string columns, whose bytes lie one after
another in a single buffer. The helpers here find words, lines and hashes in
that buffer with numpy, so no Python loop runs per word. A buffer holds many
documents; ``bounds`` gives where each begins and nothing found crosses them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from barflow.session import scratch_path

#: Bytes of text handled at once in a task (one longer text is handled alone).
BLOCK_BYTES = 2 << 20

_ALL = np.arange(256)
#: A-Z to a-z, other bytes as they are.
LOWER = np.where((_ALL >= 65) & (_ALL <= 90), _ALL + 32, _ALL).astype(np.uint8)
#: Word bytes of ``[^\x20\x09-\x0D]+``: all but ASCII white space.
VISIBLE = ~((_ALL == 32) | ((_ALL >= 9) & (_ALL <= 13)))
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and all of a non-ASCII character.
ALNUM = ((_ALL >= 48) & (_ALL <= 57)) | ((_ALL >= 97) & (_ALL <= 122)) | (_ALL >= 128)

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers of ``base`` from 0 to ``n - 1`` (``n`` at most ``BLOCK_BYTES + 1``), kept by the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, BLOCK_BYTES + 1), base & ((1 << 64) - 1), dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finishing step of a 64-bit hash (every input bit reaches every output bit)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds (length n + 1) of a string column; NULL counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of at most ``limit`` text bytes (or one row): the slice, its bytes and bounds."""
    for batch in batches:
        data, bounds = buffers(batch.column(batch.schema.get_field_index(column)))
        lo, n = 0, len(bounds) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
            lo = hi


def joined_blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """As ``blocks``, but small batches are put together until ``limit`` is reached."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        data, bounds = buffers(table.column(column))
        return table, data, bounds

    for part, data, _ in blocks(batches, column, limit):
        if held and size + len(data) > limit:
            yield flush()
            held, size = [], 0
        held.append(part)
        size += len(data)
    if held:
        yield flush()


def words(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``table`` bytes: starts, ends, and the word index where each document begins (n + 1)."""
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = table[data]
    full = bounds[:-1] < bounds[1:]
    begin, last = bounds[:-1][full], bounds[1:][full] - 1
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    first[begin] = inside[begin]
    final = inside.copy()
    final[:-1] &= ~inside[1:]
    final[last] = inside[last]
    starts, ends = np.flatnonzero(first), np.flatnonzero(final) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte strings ``data[starts[i]:ends[i]]`` (in order, not overlapping) as an Arrow array."""
    n = len(starts)
    if n == 0:
        return pa.array([], pa.binary())
    offsets = np.empty(2 * n, np.int32)
    offsets[0::2], offsets[1::2] = starts, ends
    both = pa.Array.from_buffers(pa.binary(), 2 * n - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return both.take(pa.array(np.arange(0, 2 * n - 1, 2)))


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Exact dictionary encoding of the pieces: a code for each, and the distinct byte strings."""
    coded = pieces(data, starts, ends).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int32), coded.dictionary


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of ``(byte + 1) * base ** place`` before each place of at most ``BLOCK_BYTES`` bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(data)), out=sums[1:])
    return sums


def _long_hash(data: np.ndarray) -> int:
    """The sum of a piece longer than a block, a block at a time."""
    total = 0
    for lo in range(0, len(data), BLOCK_BYTES):
        total += int(_prefix_sums(data[lo : lo + BLOCK_BYTES])[-1]) * pow(_BASE, lo, 1 << 64)
    return total % (1 << 64)


def piece_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the pieces (in order, not overlapping); equal bytes give equal hashes wherever they lie.

    Works through a stretch of at most ``BLOCK_BYTES`` at a time, so a very long text takes little more than its words do.
    """
    h = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        begin = int(starts[lo])
        hi = int(np.searchsorted(ends, begin + BLOCK_BYTES, "right"))
        if hi <= lo:
            h[lo] = _long_hash(data[begin : ends[lo]])
            lo += 1
            continue
        sums = _prefix_sums(data[begin : ends[hi - 1]])
        first = starts[lo:hi] - begin
        h[lo:hi] = (sums[ends[lo:hi] - begin] - sums[first]) * _power(_INVERSE, len(sums))[first]
        lo = hi
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(units: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of each ``width`` consecutive 64-bit units (no regard to documents)."""
    n = len(units) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h = h * np.uint64(_BASE) + units[j : j + n]
    return mix(h)


def counts_before(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many flags are set before each of the ascending places."""
    out = np.zeros(len(places), np.int64)
    total = 0
    for lo in range(0, len(flags), BLOCK_BYTES):
        sums = np.cumsum(flags[lo : lo + BLOCK_BYTES], dtype=np.int32)
        i, j = np.searchsorted(places, [lo, lo + len(sums)], "right")
        out[i:j] = total + sums[places[i:j] - lo - 1]
        total += int(sums[-1])
    return out


def owners(bounds: np.ndarray) -> np.ndarray:
    """Document index of each unit, for bounds that count units."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def task_number(counter: int) -> int:
    """A number that is the same when the task runs again: partition in the high bits."""
    return (TaskContext.get().partitionId() << 32) | counter


def written(df, name: str, partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back (cuts lineage, survives lost executors)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df, name: str) -> str:
    """``name``, or with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark=None) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that went out of use (it acts when the driver collects garbage)."""
    import gc

    from pyspark.sql import SparkSession

    gc.collect()
    if session := spark or SparkSession.getActiveSession():
        session.sparkContext._jvm.System.gc()
