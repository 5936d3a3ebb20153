"""A training corpus from the documents table, in five stages.

Quality rules, near duplicates, benchmark decontamination, personal data, BPE
tokens. Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``; a column beyond those is carried along.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow import ensure_importable
from barflow.llm import bpe_automaton, parity_join, phrase_index, pii, rules
from barflow.llm import text as tx

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")


#: glibc gives blocks of this size back to the system at once. Python workers outlive the stages, and what one stage frees must not add up.
GIVE_BACK_BYTES = 1 << 20


def _workers(spark: SparkSession) -> None:
    """Python workers import the library and give freed memory back (settings of the worker processes; results do not depend on them)."""
    ensure_importable(spark)
    spark.sparkContext.environment.update({"MALLOC_MMAP_THRESHOLD_": str(GIVE_BACK_BYTES), "MALLOC_TRIM_THRESHOLD_": str(GIVE_BACK_BYTES), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"})


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the decision list learned from the labels table."""
    _workers(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    prefix = tx.fresh(docs, "stat_") + "_"
    judged = tx.written(rules.with_stats(docs, prefix=prefix), "pipeline-judged")  # counted once, read by the training and the filter
    found = rules.train(judged.select("doc_id", *[F.col(prefix + c).alias(c) for c in rules.COUNTS]), labels)
    return judged.where(~rules.base_failed(prefix) & found.verdict(prefix)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows: the smallest id (rows without one come last), then the smallest row key.

    Rows are known by a hash of id and text, and equal ones by a hash of all
    columns, so rows that share an id are judged by their own texts. Rows without
    an id and without a word belong to no group and stay.
    """
    _workers(spark)
    row, whole = tx.fresh(docs, "row"), tx.fresh(docs, "whole")
    plain = [c for c, kind in docs.dtypes if "map<" not in kind]
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text")).withColumn(whole, F.xxhash64(*plain))
    found = parity_join.linked_components(keyed, doc_id=row)
    groups = tx.written(found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("group"), (F.coalesce("n_shingles", F.lit(0)) > 0).alias("linkable")).distinct(), "pipeline-groups")
    rows = keyed.select("doc_id", F.col(row).alias("key"), F.col(whole).alias("all")).join(groups, "key")
    grouped = rows.where("linkable or doc_id is not null").groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "all")).alias("best"))
    alone = rows.where("not linkable and doc_id is null").select("key", "all").distinct()
    chosen = tx.written(grouped.select("best.key", "best.all", F.lit(True).alias("single")).unionByName(alone.withColumn("single", F.lit(False))), "pipeline-chosen")
    repeated = tx.written(rows.groupBy("key", "all").count().where("count > 1").join(chosen.where("single"), ["key", "all"], "left_semi").select("key", "all"), "pipeline-repeated")
    same = lambda x: (keyed[row] == x["key"]) & (keyed[whole] == x["all"])
    kept = keyed.join(chosen, same(chosen), "left_semi").join(repeated, same(repeated), "left_anti")
    once = keyed.join(repeated, same(repeated), "left_semi").dropDuplicates([row, whole])  # only equal rows travel
    return kept.unionByName(once).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    _workers(spark)
    row = tx.fresh(docs, "row")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))  # also tells rows without an id apart
    found = phrase_index.contamination(keyed, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), doc_id=row)
    hit = tx.written(found.where("n_hit > 0").select(F.col("doc_id").alias("hit_row")).distinct(), "pipeline-hit")
    return keyed.join(hit, keyed[row] == hit["hit_row"], "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in the text and its length counted anew."""
    _workers(spark)
    spans = tx.fresh(docs, "spans")
    clean = pii.with_pii(docs, "text", spans, redacted="text").drop(spans)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    _workers(spark)
    path = f"{TOKENIZERS}/word_bpe_49k.json"
    kept = docs.select(*[c for c in ("doc_id", "lang", "source", "text") if c in docs.columns])
    return bpe_automaton.encode_and_decode(kept, path).select(
        *[c for c in kept.columns if c != "text"], F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("personal data", personal_data),
    ("BPE encoding and decoding", tokens),
]

#: SQL can't express the learned rules, the components or BPE; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    _workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = tx.written(stage(spark, docs, sf_dir), "pipeline-stage")
    return docs
