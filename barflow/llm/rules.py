r"""Quality rules: text statistics and learned decision lists.

``text_stats`` counts, for every document, words ``[^\x20\x09-\x0D]+``, their
code points, symbols, repeated lines and words in repeated 5-word windows.
``learn`` runs sequential covering over labelled statistics: it grows one
conjunction of thresholds at a time (FOIL gain on two thirds of the rows),
prunes it on the other third, keeps it if it is precise there, removes the rows
it covers and goes on. ``DecisionList.verdict`` is the list as one ordered Spark
conditional expression, so applying it is a projection inside the scan's stage.

Defined results: NULL or empty text has zero words and every count 0. Labels
that are empty, NULL or of one class give an empty list (everything passes).
Rows with NULL statistics are never rejected by a threshold. Repeated rows get
repeated results; columns other than the named ones are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.llm import text as tx

#: Words in the window whose repetition counts.
WINDOW = 5
#: Labelled rows used for learning, at most (chosen by a hash of the id).
MAX_LABELLED = 40_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bytes", "n_upper", "n_letters", "n_digits", "n_exclaim")
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"[#*$%&|<>]"[1:-1], np.uint8))
_UPPER = np.isin(np.arange(256), np.arange(65, 91))
_LETTER = _UPPER | np.isin(np.arange(256), np.arange(97, 123))
_DIGIT = np.isin(np.arange(256), np.arange(48, 58))


def _per_document(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(tx.counts_before(flags, bounds))


def _distinct_per_document(doc: np.ndarray, code: np.ndarray, n: int) -> np.ndarray:
    if len(code) == 0:
        return np.zeros(n, np.int64)
    both = np.unique(doc.astype(np.int64) * (int(code.max()) + 1) + code)
    return np.bincount(both // (int(code.max()) + 1), minlength=n).astype(np.int64)


def repeated_words(word_code: np.ndarray, word_bounds: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Words of each document that lie in a ``width``-word window found twice or more in it (the first included)."""
    n = len(word_code)
    out = np.zeros(n, bool)
    doc = tx.owners(word_bounds)
    if n < width:
        return _per_document(out, word_bounds)
    h = tx.window_hashes(tx.mix(word_code.astype(np.uint64) + np.uint64(1)), width)
    at = np.flatnonzero(doc[: n - width + 1] == doc[width - 1 :])
    h = h[at] ^ tx.mix(doc[at].astype(np.uint64) + np.uint64(77))
    order = np.argsort(h, kind="stable")
    h, place = h[order], at[order]
    same = (h[1:] == h[:-1]) & (doc[place[1:]] == doc[place[:-1]])
    twice = np.zeros(len(h), bool)
    twice[1:] |= same
    twice[:-1] |= same
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, place[twice], 1)
    np.add.at(edge, place[twice] + width, -1)
    return _per_document(np.cumsum(edge[:-1]) > 0, word_bounds)


def count_block(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of every document in one buffer."""
    n = len(bounds) - 1
    starts, ends, word_bounds = tx.words(data, bounds, tx.VISIBLE)
    code, _ = tx.codes(data, starts, ends)
    out = {"n_words": np.diff(word_bounds)}
    visible = tx.VISIBLE[data]
    out["word_chars"] = _per_document(visible & ((data & 0xC0) != 0x80), bounds)
    out["n_symbols"] = _per_document(_SYMBOL[data], bounds)
    # lines: from a document's start or a line feed to the next line feed or the document's end
    feed = np.flatnonzero(data == 10)
    full = bounds[:-1] < bounds[1:]
    begin = np.sort(np.concatenate([bounds[:-1][full], feed + 1]))
    stop = np.sort(np.concatenate([bounds[1:][full], feed]))
    worded = tx.counts_before(visible, stop) > tx.counts_before(visible, begin)
    begin, stop = begin[worded], stop[worded]
    line_code, _ = tx.codes(data, begin, stop)
    line_doc = np.searchsorted(bounds, begin, "right") - 1
    lines = np.bincount(line_doc, minlength=n).astype(np.int64)
    out["n_dup_lines"] = lines - _distinct_per_document(line_doc, line_code, n)
    out["n_repeat_words"] = repeated_words(code, word_bounds)
    out["n_lines"] = lines
    out["n_bytes"] = np.diff(bounds)
    out["n_upper"] = _per_document(_UPPER[data], bounds)
    out["n_letters"] = _per_document(_LETTER[data], bounds)
    out["n_digits"] = _per_document(_DIGIT[data], bounds)
    out["n_exclaim"] = _per_document(data == 33, bounds)
    return out


def with_stats(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``df`` with the count columns added (those of the same name are replaced). No shuffle."""
    new = [prefix + c for c in COUNTS]
    fields = [f for f in df.schema.fields if f.name not in new]
    schema = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in new]])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, bounds in tx.blocks(batches, text):
            counted = count_block(data, bounds)
            columns = [part.column(part.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(counted[c].astype(np.int64)) for c in COUNTS]], [*names, *new])

    return df.mapInArrow(run, schema)


def text_stats(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts, one row for each row of ``df``."""
    return with_stats(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))).drop("text")


def base_failed(prefix: str = "") -> Column:
    """Fixed base rule: under 10 words, or over a fifth of them in repeated windows."""
    n, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (n < 10) | (100 * repeated > 20 * n)


#: Features of the rules: a count as a share of another. Length itself, shares that fall with length (distinct
#: words) and what follows the language (word length, accents) are left out, so that no clean document is judged by them.
FEATURES: dict[str, tuple[str, str | None]] = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "exclaims_per_word": ("n_exclaim", "n_words"),
    "upper_share": ("n_upper", "n_letters"),
    "digit_share": ("n_digits", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def feature(name: str, prefix: str = "") -> Column:
    count, of = FEATURES[name]
    value = F.col(prefix + count).cast("double")
    return value if of is None else F.try_divide(value, F.col(prefix + of).cast("double"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        with np.errstate(invalid="ignore"):
            return values > self.threshold if self.above else values <= self.threshold

    def expression(self, prefix: str = "") -> Column:
        value = feature(self.feature, prefix)
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass
class DecisionList:
    """Ordered conjunctions; a document that meets one is rejected."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def verdict(self, prefix: str = "") -> Column:
        """True for documents that pass, as one ordered conditional expression."""
        out: Column | None = None
        for rule in self.rules:
            met = F.lit(True)
            for c in rule:
                met = met & F.coalesce(c.expression(prefix), F.lit(False))
            out = F.when(met, F.lit(False)) if out is None else out.when(met, F.lit(False))
        return F.lit(True) if out is None else out.otherwise(F.lit(True))

    def describe(self) -> list[str]:
        return [" and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:.6g}" for c in rule) for rule in self.rules]


def _gain(p: np.ndarray, n: np.ndarray, p0: int, n0: int) -> np.ndarray:
    """FOIL's gain of conjunctions that keep p of p0 positives and n of n0 negatives."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -np.inf)


def _best_condition(table: dict[str, np.ndarray], positive: np.ndarray, cuts: dict[str, np.ndarray]) -> tuple[float, Condition | None]:
    p0, n0 = int(positive.sum()), int((~positive).sum())
    best: tuple[float, Condition | None] = (0.0, None)
    for name, thresholds in cuts.items():
        values = table[name]
        valid = ~np.isnan(values)
        slot = np.searchsorted(thresholds, values[valid], "left")  # values <= thresholds[i] have slot <= i
        p = np.cumsum(np.bincount(slot[positive[valid]], minlength=len(thresholds) + 1))
        n = np.cumsum(np.bincount(slot[~positive[valid]], minlength=len(thresholds) + 1))
        for above, pk, nk in ((False, p[:-1], n[:-1]), (True, p[-1] - p[:-1], n[-1] - n[:-1])):
            gains = _gain(pk, nk, p0, n0)
            if len(gains) and gains[i := int(np.argmax(gains))] > best[0] + 1e-9:
                best = float(gains[i]), Condition(name, above, float(thresholds[i]))
    return best


def learn(labelled: DataFrame, label: str, bad: int = 0, prefix: str = "", min_precision: float = 0.97, min_cover: int = 5, max_rules: int = 24, max_conditions: int = 4, max_rows: int = MAX_LABELLED) -> DecisionList:
    """Sequential covering over labelled statistics; rules reject documents whose ``label`` is ``bad``.

    ``labelled`` has the count columns, the label and ``doc_id``. At most
    ``max_rows`` rows (the documented bound; chosen by the smallest hash of the
    id, so the same rows each time) reach the driver, as numbers only.
    """
    rank = F.xxhash64(F.lit(17), "doc_id")
    labelled = labelled.where(F.col(label).isNotNull())
    share = min(1.0, 1.2 * max_rows / max(1, labelled.count()))  # a little more than the bound, before tasks send rows
    rows = (
        labelled.where(rank <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63))))
        .select(rank.alias("_rank"), (F.col(label) == bad).alias("_bad"), *[feature(f, prefix).alias(f) for f in FEATURES])
        .orderBy("_rank", "_bad", *FEATURES)
        .limit(max_rows)
        .toPandas()
    )
    positive = rows["_bad"].to_numpy(dtype=bool)
    table = {f: rows[f].to_numpy(dtype=float) for f in FEATURES}
    prune_part = (rows["_rank"].to_numpy(dtype=np.int64) >> 7) % 3 == 0
    left = np.ones(len(rows), bool)
    found = DecisionList()
    cuts = {}
    for f, values in table.items():
        seen = np.unique(values[~np.isnan(values) & ~prune_part])
        if len(seen) > 1:
            middle = (seen[1:] + seen[:-1]) / 2
            cuts[f] = middle if len(middle) <= 512 else np.unique(np.quantile(middle, np.linspace(0, 1, 512)))
    while len(found.rules) < max_rules:
        inside = left & ~prune_part
        rule: list[Condition] = []
        while len(rule) < max_conditions and (positive & inside).any() and (~positive & inside).any():
            gain, condition = _best_condition({f: v[inside] for f, v in table.items()}, positive[inside], cuts)
            if condition is None:
                break
            rule.append(condition)
            inside &= condition.holds(table)
        if not rule:
            break
        best: tuple[float, int] = (-1.0, 0)
        for k in range(1, len(rule) + 1):  # prune: the shortest beginning with the best worth on the held-out third
            met = left & prune_part
            for c in rule[:k]:
                met &= c.holds(table)
            p, n = int((positive & met).sum()), int((~positive & met).sum())
            if p >= min_cover and (worth := p / (p + n)) > best[0] + 1e-9:
                best = worth, k
        worth, k = best
        if worth < min_precision:
            break
        rule = rule[:k]
        met = left.copy()
        for c in rule:
            met &= c.holds(table)
        found.rules.append(tuple(rule))
        left &= ~met
    return found


def train(stats: DataFrame, labels: DataFrame, label: str = "quality") -> DecisionList:
    """A decision list from documents' statistics and a labels table (joined by ``doc_id``)."""
    known = labels.select(F.col("doc_id"), F.col(label).alias("_label")).where(F.col("doc_id").isNotNull() & F.col("_label").isNotNull()).groupBy("doc_id").agg(F.min("_label").alias("_label"))
    return learn(stats.select("doc_id", *COUNTS).join(known, "doc_id"), "_label")
