"""BPE encoding and decoding by a tokenization automaton.

``TokenAutomaton`` compiles a merge list into a deterministic automaton over
tokens, one gadget for each merge in order. Its states are "the last token
read". The gadget of merge ``(a, b) -> c`` adds the arc ``c`` with its end state
and cuts every ``b``-like arc that leaves an ``a``-like state: a state is a-like
while the token it stands for still ends in an unmerged ``a`` when the merge's
turn comes, an arc is b-like while its token still begins with an unmerged
``b``. What a token still begins and ends with is a chain of its left or right
parts, each alive until the rank at which it was merged, so a cut is stored once
and inherited along the chains. A token sequence is what BPE makes of its text
exactly if the automaton reads it without using a cut arc, and each word has one
such path.

Encoding walks that path: for a word's prefixes from short to long it notes the
last token of the prefix, the only token that ends there and whose arc leaves
the state of the prefix before it. Distinct words are taken in sorted order, so
a prefix shared with the word before is not walked again. Decoding emits the
labels of the arcs.

The texts are split into words as the tokenizer file says (special tokens, NFC,
white space, lower case, split pattern). Defined results: NULL and empty texts
have no tokens and decode to empty text; repeated rows give repeated results;
columns that have the name of a new one are replaced, others stay.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from barflow.llm import text as tx

#: Distinct words whose tokens a worker keeps (then it starts anew; only speed depends on it).
KEPT_WORDS = 250_000
#: Entries of the table of arcs that a worker keeps (likewise).
KEPT_ARCS = 250_000
_FOREVER = 1 << 60


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes: printable Latin-1 for itself, the others from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


_SPACE, _LETTER, _ALONE, _OTHER = 0, 1, 2, 3
_LAST_POINT = 0x10FFFF
# The letters that an apostrophe of the split pattern takes along.
_CONTRACTED_ONE, _CONTRACTED_TWO = ("s", "t", "m", "d"), ("re", "ve", "ll")
# Fixed value: the split pattern that ``split_all`` follows.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=1)
def code_point_kinds() -> np.ndarray:
    """White space, letter, number (a word each) or other, for every code point."""
    kinds = np.full(_LAST_POINT + 1, _OTHER, np.uint8)
    points = "".join(map(chr, (*range(0xD800), *range(0xE000, _LAST_POINT + 1))))
    for pattern, kind in ((r"\p{L}", _LETTER), (r"\p{N}", _ALONE), (r"\p{White_Space}", _SPACE)):
        kinds[[ord(c) for c in regex.findall(pattern, points)]] = kind
    return kinds


class TokenAutomaton:
    """Deterministic automaton of correct token sequences for one merge list."""

    def __init__(self, labels: dict[str, int], merges: Iterable[tuple[str, str]], word_end: str = ""):
        self.ids = labels
        self.word_end = word_end
        self.left: dict[int, tuple[int, int]] = {}  # token: (its first part, rank at which that part is merged)
        self.right: dict[int, tuple[int, int]] = {}
        self.cuts: dict[tuple[int, int], int] = {}  # (a, b): rank of the merge that cuts b after a
        self.known: dict[int, bool] = {}
        self.wide = max(labels.values(), default=0) + 1
        arcs = {i for t, i in labels.items() if len(t[: -len(word_end)] if word_end and t.endswith(word_end) else t) == 1}
        for rank, (a, b) in enumerate(merges):
            self._gadget(labels[a], labels[b], labels[a + b], rank, arcs)
        # arcs by their label's letters; those that only end a word are kept apart
        self.inner = {t: i for t, i in labels.items() if i in arcs and not (word_end and t.endswith(word_end))}
        self.final = {t[: -len(word_end)]: i for t, i in labels.items() if i in arcs and t.endswith(word_end)} if word_end else self.inner
        self.longest = max(map(len, [*self.inner, *self.final]), default=1)

    def _gadget(self, a: int, b: int, c: int, rank: int, arcs: set[int]) -> None:
        """Add arc ``c`` for ``a b`` if that path is still whole, and cut ``b`` after ``a``."""
        if a in arcs and b in arcs and c not in arcs and not self._crosses(a, b, rank):
            arcs.add(c)
            self.left[c] = (a, rank)
            self.right[c] = (b, rank)
        self.cuts.setdefault((a, b), rank)

    def _crosses(self, first: int, second: int, before: int = _FOREVER) -> bool:
        """Whether a merge of a rank below ``before`` joins the end of ``first`` with the beginning of ``second``."""
        cuts = self.cuts
        x, x_until = first, _FOREVER
        while True:
            y, y_until = second, _FOREVER
            while True:
                rank = cuts.get((x, y))
                # an equal rank: merges go from left to right, so the part on the left is gone, that on the right is not
                if rank is not None and rank < x_until and rank <= y_until and rank < before:
                    return True
                part = self.left.get(y)
                if part is None:
                    break
                y, y_until = part
            part = self.right.get(x)
            if part is None:
                return False
            x, x_until = part

    def follows(self, state: int, token: int) -> bool:
        """Whether arc ``token`` leaves the state after ``state`` (worked out once, then read from the table)."""
        key = state * self.wide + token
        known = self.known.get(key)
        if known is None:
            if len(self.known) >= KEPT_ARCS:
                self.known.clear()
            known = self.known[key] = not self._crosses(state, token)
        return known

    def encode_sorted(self, words: Iterable[str]) -> Iterator[list[int]]:
        """Token ids of each of the sorted words (letters that stand for bytes).

        ``path[i]`` is the last token of ``word[:i + 1]`` with the node that its
        arc leaves; the part of the path that the word before shares is kept.
        """
        path: list[tuple[int, tuple | None]] = []
        last = ""
        known, follows, wide, longest = self.known, self.follows, self.wide, self.longest
        for word in words:
            shared = 0
            for x, y in zip(last, word):
                if x != y:
                    break
                shared += 1
            n = len(word)
            del path[min(shared, max(n - 1, 0)) :]
            last, node = word, None
            for end in range(len(path) + 1, n + 1):
                get = (self.inner if end < n else self.final).get
                token = get(word[:end]) if end <= longest else None
                if token is not None:
                    node = token, None
                else:
                    for start in range(max(1, end - longest), end):
                        token = get(word[start:end])
                        if token is not None:
                            before = path[start - 1]
                            ok = known.get(before[0] * wide + token)
                            if ok or ok is None and follows(before[0], token):
                                node = token, before
                                break
                    else:
                        raise ValueError(f"no token path for {word!r}")
                if end < n:
                    path.append(node)
            ids = []
            while node is not None:
                ids.append(node[0])
                node = node[1]
            ids.reverse()
            yield ids


class Tokenizer:
    """Words, ids and labels of one tokenizer file (word-end BPE over byte letters)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = TokenAutomaton(model["vocab"], merges, model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # a special token is replaced by a mark, a code point that stands for no character
        self.marks = {t: chr(_LAST_POINT - i) for i, t in enumerate(self.special)}
        self.kinds = code_point_kinds().copy()
        self.kinds[[ord(m) for m in self.marks.values()]] = _ALONE
        if split["pattern"]["Regex"] != SPLIT_PATTERN:
            raise ValueError("the tokenizer file has another split pattern")
        # the file's \s is Unicode white space; the regex module's also takes U+001C to U+001F
        self.split = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
        self._start_anew()

    def _start_anew(self) -> None:
        """Forget all words but the special tokens."""
        self.kept = {f"\0{i}": k for k, i in enumerate(self.special.values())}
        self.kept_ids = array("i", self.special.values())
        self.kept_ends = array("q", range(1, len(self.kept) + 1))

    def normal(self, text: str) -> str:
        """The text as the file normalises it (white space stays: it only separates)."""
        return (text if text.isascii() else unicodedata.normalize("NFC", text).replace("Σ", "σ")).lower()

    def words(self, text: str) -> list[str]:
        """Normalised, split words of one text; a special token is a word of its own (no other word has a NUL before digits)."""
        found: list[str] = []
        for part in self.cut.split(text) if self.cut else (text,):
            if part in self.special:
                found.append(f"\0{self.special[part]}")
            elif part:
                found += self.split.findall(self.normal(part))
        return found

    def split_all(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray]:
        """As ``words`` for many texts: a code for each word, the distinct words, and where each text's begin (n + 1).

        The split pattern's classes are looked up for all code points at once:
        runs of letters, single numbers, runs of other visible characters; an
        apostrophe alone takes the letters of a contraction that follow it.
        """
        normal = []
        for t in texts:
            for token, mark in self.marks.items():
                if token in t:
                    t = t.replace(token, mark)
            normal.append(self.normal(t))
        joined = "".join(normal)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in normal])]).astype(np.int64)
        kind = self.kinds[points]
        begin = bounds[:-1][bounds[:-1] < bounds[1:]]
        goes_on = np.zeros(len(points) + 1, bool)  # with the code point before
        goes_on[1:-1] = (kind[1:] == kind[:-1]) & ((kind[1:] == _LETTER) | (kind[1:] == _OTHER))
        goes_on[begin] = False
        seen = kind != _SPACE
        starts, ends = np.flatnonzero(seen & ~goes_on[:-1]), np.flatnonzero(seen & ~goes_on[1:]) + 1
        k = np.flatnonzero((ends[:-1] - starts[:-1] == 1) & (points[starts[:-1]] == ord("'")) & (starts[1:] == ends[:-1]) & (kind[starts[1:]] == _LETTER) & ~np.isin(starts[1:], begin))
        if len(k):
            first, size = points[starts[k + 1]], ends[k + 1] - starts[k + 1]
            second = points[np.minimum(starts[k + 1] + 1, len(points) - 1)]
            pair = np.zeros(len(k), bool)
            for x, y in _CONTRACTED_TWO:
                pair |= (first == ord(x)) & (second == ord(y)) & (size > 1)
            takes = np.where(np.isin(first, [ord(x) for x in _CONTRACTED_ONE]), 1, np.where(pair, 2, 0))
            ends[k] += takes
            starts[k + 1] += takes
            left = starts < ends
            starts, ends = starts[left], ends[left]
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width)])
        code, distinct = tx.codes(np.frombuffer(joined.encode(), np.uint8), place[starts], place[ends])
        named = {m: f"\0{self.special[t]}" for t, m in self.marks.items()}
        return code, [named.get(w, w) for w in map(bytes.decode, distinct.to_pylist())], np.searchsorted(starts, bounds)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's begin (n + 1)."""
        if any(m in t for t in texts if not t.isascii() for m in self.marks.values()):  # a mark stands in a text itself
            split = [self.words(t) for t in texts]
            number: dict[str, int] = {}
            code = np.fromiter((number.setdefault(w, len(number)) for own in split for w in own), np.int64, sum(map(len, split)))
            distinct, bounds = list(number), np.concatenate([[0], np.cumsum([len(x) for x in split])]).astype(np.int64)
        else:
            code, distinct, bounds = self.split_all(texts)
        if len(self.kept) > KEPT_WORDS:
            self._start_anew()
        kept = self.kept
        new = sorted((w.encode().decode("latin-1").translate(self.letters), w) for w in distinct if w not in kept)
        for (_, word), ids in zip(new, self.automaton.encode_sorted(x for x, _ in new)):
            kept[word] = len(self.kept_ends)
            self.kept_ids.extend(ids)
            self.kept_ends.append(len(self.kept_ids))
        if not len(code):
            return np.empty(0, np.int32), bounds
        places = np.array([kept[w] for w in distinct], np.int64)[code]
        stop = np.array(self.kept_ends, np.int64)
        begin = np.concatenate([[0], stop[:-1]])[places]
        n = stop[places] - begin
        ends = np.cumsum(n)
        ids = np.array(self.kept_ids, np.int32)[np.repeat(begin - (ends - n), n) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[bounds]


def labels_of(path: str) -> list[str]:
    """The label of each id's arc."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    known = {**{i: t for t, i in spec["model"]["vocab"].items()}, **{t["id"]: t["content"] for t in spec["added_tokens"]}}
    return [known.get(i, "") for i in range(max(known) + 1)]


@lru_cache(maxsize=2)
def load(path: str) -> Tokenizer:
    return Tokenizer(path)


@lru_cache(maxsize=2)
def arcs_of(path: str) -> pa.Array:
    return pa.array(labels_of(path), pa.string())


def _emitted(labels: pa.Array, flat: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The labels of each list of ids, joined by spaces."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), labels.take(flat)), " ")


#: Texts of a block that are decoded at once.
DECODED_ROWS = 512


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of its whole texts (no special tokens added). No shuffle."""
    fields = [f for f in df.schema.fields if f.name != ids]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(path)
        for part, _, _ in tx.blocks(batches, text):
            texts = [t or "" for t in part.column(part.schema.get_field_index(text)).to_pylist()]
            flat, bounds = tokenizer.encode_all(texts)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in names], lists], [*names, ids])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the labels of its ids' arcs, joined by spaces (the tokenizer file has no decoder)."""
    fields = [f for f in df.schema.fields if f.name != text]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = arcs_of(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, DECODED_ROWS):
                part = batch.slice(lo, DECODED_ROWS)
                own = part.column(part.schema.get_field_index(ids))
                own = own.fill_null([]) if own.null_count else own
                decoded = _emitted(labels, own.flatten(), own.offsets.to_numpy().astype(np.int64))
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in names], decoded], [*names, text])

    return df.mapInArrow(run, schema)


def encode_and_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` without its texts, with their token ids and the text decoded from these: one Python step, so one worker for a task."""
    fields = [f for f in df.schema.fields if f.name not in (text, ids, decoded)]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, labels = load(path), arcs_of(path)
        for block, _, _ in tx.blocks(batches, text):
            texts = [t or "" for t in block.column(block.schema.get_field_index(text)).to_pylist()]
            flat, bounds = tokenizer.encode_all(texts)
            for lo in range(0, len(texts), DECODED_ROWS):
                part, own = block.slice(lo, DECODED_ROWS), bounds[lo : lo + DECODED_ROWS + 1]
                found = pa.array(flat[own[0] : own[-1]], pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(own - own[0], pa.int32()), found)
                yield pa.RecordBatch.from_arrays([*[part.column(part.schema.get_field_index(c)) for c in names], lists, _emitted(labels, found, own)], [*names, ids, decoded])

    return df.mapInArrow(run, schema)
