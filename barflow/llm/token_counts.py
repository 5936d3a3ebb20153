"""Token counts by dynamic programming shared along a trie.

A text's pre-tokens are its runs of visible characters, each with a word mark
before it. The distinct pre-tokens of a task's pack of texts are put in order,
which is the depth-first order of their trie: two neighbours share the path to
the node where they part. Each node holds the best unigram score of its prefix
(forward score) and the tokens on that path; it is computed once, from the nodes
above it and the vocabulary's pieces that end there, however many pre-tokens
pass through it. The node at which a pre-token ends stores its count, and a
document's count is the sum over its words.

The vocabulary is a ranked list of pieces; a piece's unigram probability follows
Zipf's law of its rank. Equal scores go to fewer tokens, then to the longer last
piece. A character in no piece costs one byte token for each UTF-8 byte.

Defined results: NULL and empty texts have no pre-tokens and no tokens; repeated
rows give repeated results; only the named columns are read. Nothing is shuffled:
pre-tokens are shared within a task's pack, whose size bounds the memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import text as tx

#: Text bytes whose pre-tokens share one trie.
PACK_BYTES = 8 << 20
MARK = "▁"
#: Log-probability of a byte token, below every piece's.
BYTE_SCORE = -30.0


def zipf_scores(pieces: Iterable[str]) -> dict[str, float]:
    """Unigram log-probabilities of ranked pieces by Zipf's law."""
    ranked = list(dict.fromkeys(p for p in pieces if p))
    norm = math.log(sum(1.0 / (r + 2) for r in range(len(ranked)))) if ranked else 0.0
    return {p: -math.log(r + 2) - norm for r, p in enumerate(ranked)}


@lru_cache(maxsize=2)
def load_scores(path: str) -> dict[str, float]:
    """Scores of a public sentencepiece file's pieces (control, unknown and byte pieces left out)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return zipf_scores(model.id_to_piece(i) for i in range(model.get_piece_size()) if not special(i))


def counts_of_sorted(words: Iterable[str], scores: dict[str, float]) -> Iterator[int]:
    """Tokens of each of the sorted pre-tokens; the nodes of the current trie path are a stack."""
    longest = max(map(len, scores), default=0)
    get = scores.get
    best, tokens = [0.0], [0]  # of the prefixes of the last word
    last = ""
    for word in words:
        shared = 0
        for x, y in zip(last, word):
            if x != y:
                break
            shared += 1
        del best[shared + 1 :], tokens[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            top, n = -math.inf, 0
            for start in range(max(0, end - longest), end):  # longer pieces first
                score = get(word[start:end])
                if score is not None:
                    score += best[start]
                    if score > top or score == top and tokens[start] + 1 < n:
                        top, n = score, tokens[start] + 1
            if get(word[end - 1]) is None:
                width = len(word[end - 1].encode())
                score = best[end - 1] + width * BYTE_SCORE
                if score > top:
                    top, n = score, tokens[end - 1] + width
            best.append(top)
            tokens.append(n)
        last = word
        yield tokens[len(word)]


def token_counts(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_pretokens, n_tokens`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = load_scores(path)
        for part, data, bounds in tx.joined_blocks(batches, "text", PACK_BYTES):
            starts, ends, word_bounds = tx.words(data, bounds, tx.VISIBLE)
            code, distinct = tx.codes(data, starts, ends)
            words = [MARK + w.decode() for w in distinct.to_pylist()]
            order = sorted(range(len(words)), key=words.__getitem__)
            count = np.zeros(len(words), np.int64)
            count[order] = np.fromiter(counts_of_sorted((words[i] for i in order), scores), np.int64, len(order))
            sums = np.concatenate([[0], np.cumsum(count[code])])
            ids = part.column("doc_id")
            ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(word_bounds)), pa.array(sums[word_bounds[1:]] - sums[word_bounds[:-1]])], ["doc_id", "n_pretokens", "n_tokens"])

    chosen = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
