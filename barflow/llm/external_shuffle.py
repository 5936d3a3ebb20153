"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into memory-sized buckets: a seeded
hash of the id names the shard (the shard with the greatest hash wins, so one
more shard only takes rows, see ``shard_of``), and a second seeded hash of id and
text spreads a shard's rows over as many buckets as that shard's own bytes need
(rows without an id share a shard). Copies of a row whose bytes together would
fill half a bucket are told apart by their place in the input, and so spread like
other rows. The scatter is one Spark exchange, which keeps ``RUN`` neighbouring
buckets of a shard in one task, so a shard is written as few files; finding such
copies takes another exchange of digests. Pass two takes each bucket alone, shuffles it by Fisher-Yates with a
seed of its own and writes it. A record's slot is its place in the bucket plus
the rows of the shard's earlier buckets, from a small table of counts.

Everything depends on the data and the seed alone, so a task that runs again
writes the same rows. Places of copies are those in the input's partitions, so
``df`` should read files (a scan numbers its rows alike when it runs again); what
comes out of an exchange should be written first. Defined results: NULL texts have zero bytes; rows with a
NULL id go to one shard like any id; repeated rows are kept, each with its own
slot; an empty table gives an empty result; columns of ``df`` are carried along
as they are, and one with the name of a new column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.llm import text as tx

#: Text bytes in a bucket, on average.
BUCKET_BYTES = 4 << 20
#: Neighbouring buckets of a shard that one task takes, each alone, into one file.
RUN = 4
#: Bytes counted for a record besides its text.
RECORD_BYTES = 8


def record_size(text: str) -> Column:
    """UTF-8 bytes of the text (NULL: none) and the fixed part."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def shard_of(doc_id: str, shards: int, seed: int) -> Column:
    """Shard with the greatest seeded hash of (id, shard): one shard more takes rows only into itself."""
    drawn = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(F.lit(seed), F.col(doc_id), s).alias("h"), s.alias("s")))
    return F.array_max(drawn)["s"]


def _fisher_yates(n: int, seed: tuple[int, ...]) -> np.ndarray:
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(np.random.SeedSequence(seed))).shuffle(order)  # Fisher-Yates
    return order


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, doc_id: str = "doc_id", text: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write the records, shuffled, below the shared checkpoint folder and return them with ``shard``, ``bucket``, ``place``.

    The written table is partitioned by shard; each bucket is one contiguous
    run of rows in shuffled order (``place`` from 0). Memory in a task is one
    bucket.
    """
    carried = df.drop("shard", "bucket", "place")
    number = tx.fresh(carried, "row")
    shard = shard_of(doc_id, shards, seed)
    held = df.groupBy(shard.alias("shard")).agg(F.sum(record_size(text)).alias("n")).collect()  # a row for each shard
    buckets = [1] * shards
    for r in held:
        buckets[r["shard"]] = max(1, -(-int(r["n"]) // bucket_bytes))
    row, many = tx.fresh(carried, "row_hash"), tx.fresh(carried, "many")
    by_row = F.xxhash64(F.lit(seed + 1), F.col(doc_id), F.col(text))
    copies = df.groupBy(by_row.alias(row)).agg(F.count(F.lit(1)).alias("n"), F.sum(record_size(text)).alias("bytes"))
    copies = tx.written(copies.where((F.col("n") > 1) & (F.col("bytes") * 2 > bucket_bytes)).select(row, F.lit(True).alias(many)), "shards-copies")  # at most two for each bucket
    of_shard = F.element_at(F.array(*map(F.lit, buckets)), F.col("shard") + 1)
    scattered = carried.withColumns({"shard": shard, number: F.monotonically_increasing_id(), row: by_row}).join(copies, row, "left")
    spread = F.when(F.col(many), F.xxhash64(F.col(row), F.col(number))).otherwise(F.col(row))
    scattered = scattered.withColumn("bucket", F.pmod(spread, of_shard).cast("int")).drop(row, many)
    names, run = carried.columns, tx.fresh(carried, "run")
    scattered = scattered.withColumn(run, F.floor(F.col("bucket") / RUN)).repartition("shard", run)
    schema = T.StructType([*carried.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("place", T.LongType())])

    def permute(bucket: pa.Table) -> pa.Table:
        n = bucket.num_rows
        key = pa.table({"id": bucket.column(doc_id), "text": bucket.column(text), "number": bucket.column(number), "at": np.arange(n)})
        start = key.sort_by([("id", "ascending"), ("text", "ascending"), ("number", "ascending")]).column("at").to_numpy()  # arrival order is not fixed
        order = start[_fisher_yates(n, (seed & 0xFFFFFFFF, bucket.column("shard")[0].as_py(), bucket.column("bucket")[0].as_py()))]
        out = bucket.select([*names, "shard", "bucket"]).take(pa.array(order))
        return out.append_column("place", pa.array(np.arange(n, dtype=np.int64)))

    placed = scattered.groupBy("shard", run, "bucket").applyInArrow(permute, schema)
    return tx.written(placed, "shards", ("shard",))


def with_slots(shards: DataFrame) -> DataFrame:
    """The written records with ``slot``: gapless from 0 in each shard, in the order of bucket and place."""
    counts = shards.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    return shards.join(offsets, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("place")).drop("before")


def shard_report(df: DataFrame, shards: int = 24, seed: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Where every record went: id, size, checksum, shard, slot, and its shard if there were one more."""
    placed = shuffle_into_shards(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shards, seed)
    # digests of the texts first, so that only they meet the bucket offsets
    digests = placed.select("doc_id", record_size("text").alias("size"), F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"), "shard", "bucket", "place")
    return with_slots(tx.written(digests, "shard-digests")).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
        shard_of("doc_id", shards + 1, seed).alias("grown_shard"),
    )
