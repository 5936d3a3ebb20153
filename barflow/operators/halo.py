"""Skew-proof ordered windows: indexed, halo-blocked row frames.

``Window.partitionBy("symbol")`` sends every bar of a symbol to one task; one hot
symbol then decides the job. Every bounded row-frame operator in this package
(moving averages, RSI, lags, leads, look-back sequences, lag products) instead
runs on this layout:

1. ``index_rows`` gives each row a contiguous 0-based position ``_idx`` within
   its key and the key's length ``_n``. Rows are first grouped by a fixed time
   bucket of the order column (bars are unique per key and time, so a bucket
   holds a bounded number of rows however large the key is); a small
   per-(key, bucket) count table gives each bucket's start position, and
   ``row_number`` inside the bucket gives the rest.
2. ``with_halo`` cuts positions into blocks of ``block_rows`` rows
   (``_home = _idx div block_rows``). A row among the last ``preceding`` rows
   of its block is also copied into the next block, one among the first
   ``following`` rows into the previous block. The rule is local to the row:
   no join, one ``explode``, and every window partition is bounded by
   ``block_rows + preceding + following`` rows.
3. Windows run over ``block_window(keys)`` = ``partitionBy(_blk, keys)
   orderBy(_idx)``; ``core`` keeps each row once, in its home block.

Frames computed this way equal the per-key global frames whenever no frame
reaches further than the halo. Everything is a deterministic function of the
data (no sampling, no partition ids), so re-executed or recovered tasks
produce the same positions. ``order`` must be unique within ``keys``, as any
ROWS frame requires for a deterministic answer.

An ``_idx`` column is only ever contiguous (a frame keeps it when it drops
nothing or only a prefix/suffix of each key); operators that filter arbitrary
rows drop it, and ``reindex`` rebuilds it from the block layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLK = "_blk"
HOME = "_home"
IDX = "_idx"
CNT = "_n"
DEFAULT_BLOCK_DAYS = 1024
DEFAULT_BLOCK_SECONDS = 7 * 86400
DEFAULT_BLOCK_UNITS = 1024
DEFAULT_BLOCK_ROWS = 4096

_HELPERS = (BLK, HOME, IDX, CNT, "_s", "_tb", "_bc", "_lrn")


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Equi-join on ``on`` with NULL-safe equality (a NULL key or order value keeps its rows)."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
    cond = None
    for c in on:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond).drop(*[f"_r_{c}" for c in on])


def bucket(df: DataFrame, order: str, block: float | None = None) -> Column:
    """Fixed-width bucket of the order column (long)."""
    dt = df.schema[order].dataType
    c = F.col(order)
    if isinstance(dt, T.DateType):
        width = block or DEFAULT_BLOCK_DAYS
        return F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / F.lit(width)).cast("long")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        width = block or DEFAULT_BLOCK_SECONDS
        return F.floor(F.unix_seconds(c.cast("timestamp")) / F.lit(width)).cast("long")
    width = block or DEFAULT_BLOCK_UNITS
    return F.floor(c.cast("double") / F.lit(float(width))).cast("long")


def index_rows(
    df: DataFrame,
    keys: Sequence[str] | str = ("symbol",),
    order: str = "date",
    block: float | None = None,
) -> DataFrame:
    """Add ``_idx`` (0-based contiguous position within key) and ``_n`` (key length)."""
    keys = _keys(keys)
    homed = df.withColumn("_tb", bucket(df, order, block))
    summ = homed.groupBy(*keys, "_tb").agg(F.count(F.lit(1)).alias("_bc"))
    wk = Window.partitionBy(*keys).orderBy("_tb")  # one row per key and bucket
    summ = summ.select(
        *keys,
        "_tb",
        F.coalesce(F.sum("_bc").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")).alias(
            "_s"
        ),
        F.sum("_bc").over(Window.partitionBy(*keys)).alias(CNT),
    )
    local = homed.withColumn("_lrn", F.row_number().over(Window.partitionBy(*keys, "_tb").orderBy(order)) - 1)
    out = join_null_safe(local, summ, [*keys, "_tb"])
    return out.withColumn(IDX, F.col("_s") + F.col("_lrn")).drop("_tb", "_s", "_lrn")


def with_halo(indexed: DataFrame, preceding: int, following: int = 0,
              block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Add ``_home`` (the row's block) and ``_blk`` (home, or a neighbour for halo copies)."""
    block_rows = max(block_rows, preceding, following)  # a halo copy comes from the neighbour block only
    b = F.lit(int(block_rows))
    home = F.floor(F.col(IDX) / b).cast("long")
    pos = F.col(IDX) - F.col(HOME) * b
    targets = [F.col(HOME)]
    if preceding:
        targets.append(F.when(pos >= F.lit(block_rows - preceding), F.col(HOME) + 1))
    if following:
        targets.append(F.when(pos < F.lit(following), F.col(HOME) - 1))
    out = indexed.drop(*[c for c in (BLK, HOME) if c in indexed.columns]).withColumn(HOME, home)
    if len(targets) == 1:
        return out.withColumn(BLK, F.col(HOME))
    return out.withColumn(BLK, F.explode(F.filter(F.array(*targets), lambda t: t.isNotNull())))


def blocked(
    df: DataFrame,
    keys: Sequence[str] | str = ("symbol",),
    order: str = "date",
    preceding: int = 0,
    following: int = 0,
    block: float | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Index (unless ``df`` already carries a contiguous ``_idx``/``_n``) and add halos."""
    base = df if (IDX in df.columns and CNT in df.columns) else index_rows(df, keys, order, block)
    return with_halo(base, preceding, following, block_rows)


def block_window(keys: Sequence[str] | str = ("symbol",)):
    """Window spec to use on a ``with_halo`` frame."""
    return Window.partitionBy(BLK, *_keys(keys)).orderBy(IDX)


def core(df: DataFrame) -> DataFrame:
    """Keep each row once (drop halo copies); ``_blk`` then equals the home block."""
    return df.where(F.col(BLK) == F.col(HOME)).drop(HOME)


def reindex(df: DataFrame, keys: Sequence[str] | str = ("symbol",), order: str = "date") -> DataFrame:
    """Contiguous ``_idx`` and per-key count ``_n`` for the rows left in ``df``.

    ``df`` holds core rows with ``_blk`` (possibly filtered anywhere). Block
    counts are a small aggregate; the local rank reuses the ``(_blk, keys)``
    partitioning of the window pass that produced ``df``.
    """
    keys = _keys(keys)
    base = df.drop(*[c for c in (IDX, CNT, "_s") if c in df.columns])
    per_block = base.groupBy(*keys, BLK).agg(F.count(F.lit(1)).alias("_bc"))
    wk = Window.partitionBy(*keys).orderBy(BLK)
    offs = per_block.select(
        *keys,
        BLK,
        F.coalesce(F.sum("_bc").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")).alias(
            "_s"
        ),
        F.sum("_bc").over(Window.partitionBy(*keys)).alias(CNT),
    )
    local = base.withColumn("_lrn", F.row_number().over(Window.partitionBy(BLK, *keys).orderBy(order)) - 1)
    out = join_null_safe(local, offs, [*keys, BLK])
    return out.withColumn(IDX, F.col("_s") + F.col("_lrn")).drop("_s", "_lrn")


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in _HELPERS if c in df.columns])
