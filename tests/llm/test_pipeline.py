"""The pipeline against its stages' brute-force versions, on a small table and on the smallest data set."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from barflow.llm import queries as named
from barflow.llm import rules
from tests.conftest import SF_SMALL
from tests.llm.test_pairs import brute_components
from tests.llm.test_texts import base_pii, brute_hits, brute_stats


def test_registered_queries():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and [k for k, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(k for k in named.QUERIES if int(k[2:].split("_")[0]) <= 10))
def test_one_row_for_each_document(spark, name):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id")
    got = named.QUERIES[name](spark, SF_SMALL).select("doc_id")
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in docs.collect())


def test_pipeline_against_brute_force(spark):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    library.no_truncation()
    library.no_padding()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    # 1: the same learned list on brute-force counts
    learned = rules.train(rules.text_stats(docs), spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    passes = {r.doc_id for r in rules.text_stats(docs).where(learned.verdict()).collect()}
    stats = {i: brute_stats(t) for i, t in rows}
    rows = [(i, t) for i, t in rows if i in passes and stats[i][0] >= 10 and 100 * stats[i][4] <= 20 * stats[i][0]]
    # 3, 1: the smallest of each component, without benchmark windows
    group = brute_components(rows)
    rows = [(i, t) for i, t in rows if group[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(k[2] for k in brute_hits([(i, t)], items))]
    # 10, 6
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == {i for i, _ in rows} and len(rows) > 50
    for i, t in rows:
        if not base_pii(t):
            ids = library.encode(t, add_special_tokens=False).ids
            assert list(got[i].ids) == ids
            assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_columns_and_odd_rows(spark, make_docs, tmp_path):
    words = " ".join(f"word{i}x" for i in range(40))
    other = " ".join(f"some{i}y" for i in range(40))
    rows = [(1, words), (2, words), (2, words), (None, other), (3, None), (4, ""), (5, other + " mail a@b.cd")]
    docs = make_docs(rows).selectExpr("*", "'x' as spans", "1 as row", "2 as stat_")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of the kind")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        docs = stage(spark, spark.read.parquet(f"{tmp_path}/{name}"), str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "spans", "row", "stat_"]
    got = Counter((r.doc_id, r.text, r.n_chars) for r in docs.collect())
    clean = other + " mail <EMAIL>"
    assert got[(1, words, len(words))] == 1 and got[(5, clean, len(clean))] == 1 and sum(got.values()) == 2  # a near copy without an id goes first
    empty = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_near_duplicates_by_row(spark, make_docs, tmp_path):
    words = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"]
    near = lambda k: words[k] + " more"
    rows = [(1, words[0]), (2, words[0]), (2, words[1]), (3, words[2]), (3, near(2)), (None, words[3]), (None, near(3)), (None, words[3]), (7, words[4]), (7, words[4]), (None, ""), (None, ""), (None, words[5]), (8, near(5))]
    make_docs(rows).withColumn("x", F.monotonically_increasing_id()).write.parquet(f"{tmp_path}/docs")
    for docs in (make_docs(rows), spark.read.parquet(f"{tmp_path}/docs")):
        got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect())
        assert got[(1, words[0])] == 1 and got[(2, words[1])] == 1 and (2, words[0]) not in got  # an id's other text stays
        assert got[(3, words[2])] + got[(3, near(2))] == 1 and got[(None, words[3])] + got[(None, near(3))] == 1
        assert got[(8, near(5))] == 1 and got[(7, words[4])] == 1 and got[(None, "")] == 2 and (None, words[5]) not in got and sum(got.values()) == 8  # one with an id comes first
