import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text) pairs, over a few partitions."""

    def make(rows, parts=3):
        full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture(scope="session")
def texts():
    """Documents with copies, near copies, shared passages, junk and odd cases."""
    import random

    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefghijklmnoprstuvé") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    rows = []
    for i in range(160):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 12, 40, 150, 400]))]
        if i % 5 == 0:
            at = rnd.randint(0, len(words))
            words[at:at] = passage.split()
        if i % 9 == 0:
            words.insert(len(words) // 2, "\n")
        rows.append((i, " ".join(words)))
    for k in range(25):  # near copies in a chain and a star
        words = rows[40][1].split()
        words[rnd.randrange(len(words))] = "changed"
        rows.append((200 + k, " ".join(words)))
    rows += [(230 + k, rows[7][1]) for k in range(12)] + [(260 + k, rows[3][1].upper()) for k in range(3)]
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "one two three four"), (305, "ONE two three four"), (306, "一 二 三 四 五 六 𝒳"), (307, "a" * 5000), (308, "ab " * 4000), (309, "a" * 4990)]
    return rows
