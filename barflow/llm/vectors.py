"""Helpers of the operators on embeddings: usable rows, Arrow lists as matrices, tiles of rows by queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows and queries of one tile at most (expected; a hash deals them).
TILE_ROWS, TILE_QUERIES = 16_384, 2_048


def finite(vector: str) -> Column:
    """Whether the array is there and none of its components is NULL, NaN or infinite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    """A list column whose rows have one length, as a two-dimensional array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = np.asarray(column.flatten())
    return flat.astype(kind, copy=False).reshape(n, len(flat) // n if n else 0)


def longs(column: pa.ChunkedArray | pa.Array, missing: int = np.iinfo(np.int64).max) -> np.ndarray:
    """An integer column as int64; NULL becomes ``missing`` (the largest, so NULL sorts last)."""
    column = column.cast(pa.int64()).fill_null(missing)
    return np.asarray(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)


def products(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows with an integer vector; beyond the range of a long they stay at its ends."""
    if rows.size == 0:
        return np.zeros(len(rows), np.int64)
    bound = rows.shape[1] * max(abs(int(rows.min())), abs(int(rows.max()))) * max(abs(int(one.min())), abs(int(one.max())))
    if bound < 1 << 53:  # doubles hold every partial sum exactly
        return (rows.astype(np.float64) @ one.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return rows @ one
    top = np.iinfo(np.int64)
    return np.array([min(max(x, top.min), top.max) for x in rows.astype(object) @ one.astype(object)], np.int64)


def tiles(rows: DataFrame, queries: DataFrame, key: str, row_id: str, fn, schema: str, tile_rows: int = TILE_ROWS, tile_queries: int = TILE_QUERIES) -> DataFrame:
    """``fn(rows, queries)`` (Arrow tables) over bounded tiles in which every row meets every query of its ``key``.

    Rows of a key are dealt to groups by a hash of ``row_id``, queries likewise;
    a tile is one group of each, so a key with a third of all rows is spread over
    many tasks and no task holds more than a tile. Rows travel once for each
    group of queries, queries once for each group of rows. Two counts of the
    largest key are read by the driver, nothing else.
    """
    most = lambda df: df.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    by_rows, by_queries = (max(1, -(-most(df) // size)) for df, size in ((rows, tile_rows), (queries, tile_queries)))
    dealt = lambda n: F.pmod(F.xxhash64(row_id), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("_g", dealt(by_rows)).withColumn("_h", every(by_queries))
    right = queries.withColumn("_h", dealt(by_queries)).withColumn("_g", every(by_rows))
    at = (key, "_g", "_h")
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(fn, schema)


def table_of(schema: str, **columns) -> pa.Table:
    """An Arrow table with the column types of a Spark ``name type, ...`` schema."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    fields = [pa.field(*(lambda p: (p[0], kinds[p[1]]))(f.split())) for f in schema.split(",")]
    return pa.table([pa.array(columns[f.name], f.type, from_pandas=False) for f in fields], schema=pa.schema(fields))
