"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import text as tx


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``edges`` (a, b); the label is the smallest node reachable.

    Each round rewires every node's larger neighbours to its smallest one, then
    its smaller ones; the table is written after each, so lineage stays short.
    A node with very many edges is only ever aggregated (partially first) and
    joined, never gathered. Loops and repeated edges are ignored; no edges give
    an empty table.
    """
    now = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = tx.written(now, "components")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = tx.written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        if (after := _mark(now)) == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
