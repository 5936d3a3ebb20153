"""The named queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow import ensure_importable
from barflow.llm import (
    angular_negatives,
    bpe_automaton,
    dimension_lloyd,
    external_shuffle,
    learned_partitions,
    license_scan,
    parity_join,
    phrase_index,
    pii,
    rules,
    secret_links,
    suffix_dedup,
    token_counts,
)
from barflow.llm import text as tx

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_importable(spark)  # Python workers import this package
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document, by the positional index."""
    found = phrase_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op2_external_shuffle")
def op2_external_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shuffled shards, by key."""
    return external_shuffle.shard_report(table(spark, sf_dir, "documents"))


@query("op3_parity_join")
def op3_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by the parity-sketch join."""
    return parity_join.linked_components(table(spark, sf_dir, "documents"))


@query("op4_prefix_doubling")
def op4_prefix_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of repeated 50-byte strings of all documents, by distributed prefix doubling."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 50)[0]


@query("op5_secret_links")
def op5_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, weak parts only where complementary parts meet."""
    return secret_links.secret_report(table(spark, sf_dir, "documents"))


@query("op6_bpe_automaton")
def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded by the tokenization automaton and decoded again."""
    return bpe_automaton.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), f"{TOKENIZERS}/word_bpe_49k.json").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_quality_rules")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, the fixed base rule and the learned decision list."""
    stats = tx.written(rules.text_stats(table(spark, sf_dir, "documents")), "op7-stats")
    found = rules.train(stats, table(spark, sf_dir, "labels"))
    failed = rules.base_failed()
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & found.verdict()).alias("kept"),
    )


@query("op8_trie_counts")
def op8_trie_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every whole text."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every whole text."""
    found = license_scan.license_matches(table(spark, sf_dir, "documents"))
    names = F.array_join(F.sort_array(F.array_distinct(F.transform("matches", lambda x: F.substring_index(x["license"], "~", 1)))), ",")
    spans = F.transform("matches", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"), x["end"].cast("string")))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), names.alias("licenses"), F.array_join(spans, ",").alias("spans"))


@query("op10_pii_anchors")
def op10_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document by anchor expansion."""
    return pii.pii_report(table(spark, sf_dir, "documents"))


@query("op11_learned_partitions")
def op11_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest rows of every hundredth embedding, by learned partitions of the whole table."""
    return learned_partitions.neighbours(table(spark, sf_dir, "embeddings"))


def _lloyd_sql(k: int = 8, rounds: int = 10) -> str:
    """DuckDB: the same rounds, one after another, over the kept vectors as lists of integers."""
    steps = ["""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, sha256('3:' || vec_id) AS h
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, v AS c FROM kept QUALIFY row_number() OVER (ORDER BY h) <= {k})"]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, cluster := cluster)) AS best FROM (
    SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM kept CROSS JOIN c{r}) GROUP BY vec_id)""")
        if r < rounds:
            steps.append(f"""s{r} AS MATERIALIZED (
  SELECT cluster, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
    SELECT best.cluster AS cluster, i, CAST(sum(v[i]) AS DOUBLE) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY cluster)""")
            steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(s{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN s{r} ON s{r}.cluster = c{r}.cluster)")
    return f"""WITH {", ".join(steps)}
SELECT a.vec_id, a.best.cluster AS cluster, CAST(a.best.d AS BIGINT) AS distance, CAST(sum(a.best.d) OVER (PARTITION BY a.best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = a.best.cluster"""


@query("op12_dimension_lloyd", _lloyd_sql())
def op12_dimension_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of all embeddings after ten dimension-sharded rounds."""
    return dimension_lloyd.report(table(spark, sf_dir, "embeddings"))


NEGATIVES_SQL = """WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
  n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) <= 5"""


@query("op13_angular_negatives", NEGATIVES_SQL)
def op13_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth embedding and its positives, by angular bounds over the whole table."""
    return angular_negatives.mine(table(spark, sf_dir, "embeddings"))
