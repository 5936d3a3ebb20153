"""License scans: MinHash bands over overlapping windows, exact containment after.

Templates are license notices (a parameter; the set of ``licenses`` by default). Words
are lower-cased runs of digits, letters and non-ASCII characters, shingles three
words. For a template of m words every m-word window of a text, at every
position, has a MinHash signature, taken by sliding minima over the shingles'
hashes (minima over 1, 2, 4 ... shingles are shared by all window sizes).
Signatures are cut into bands; a window that agrees with a template in a band is
a candidate. With BANDS bands of ROWS rows a window of Jaccard similarity s is
found with probability ``1 - (1 - s**ROWS)**BANDS``: over 0.997 from s = 0.67 on
and always for an exact copy. Candidates are verified by the exact share of the
template's shingles in the window; a template's numbers and names must be in their
place, and a word like "Lesser" that it lacks must not be there. Of overlapping
windows, of whatever templates, the one with the most shingles is reported.

Defined results: NULL and empty texts, and those shorter than a template, match
nothing; ties go to the leftmost window; repeated rows give repeated results;
only the named columns are read. Nothing is shuffled, the templates are a small
parameter, and memory is one block of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm import licenses
from barflow.llm import text as tx

BANDS, ROWS = 10, 2
SHINGLE = 3
#: Share of a template's shingles that a window must hold.
CONTAINED = 0.8

#: Notices with a wording of their own; the default set (``licenses.templates()``) adds names, versions and SPDX tags.
TEMPLATES: dict[str, str] = licenses.NOTICES
# Words that tell licenses apart, besides numbers. The first must not stand in a window whose template lacks them.
TELLING = ("affero", "lesser", "nc", "nd", "noncommercial", "noderivatives", "noderivs", "sa", "sharealike")
NAMING = ("apache", "artistic", "attribution", "boost", "bsd", "cddl", "cecill", "eclipse", "eupl", "expat", "isc", "library", "mit", "mozilla", "zlib", "zope")
TAG = ("spdx", "license", "identifier")


def _units(data: np.ndarray, bounds: np.ndarray):
    data = tx.LOWER[data]
    starts, ends, word_bounds = tx.words(data, bounds, tx.ALNUM)
    return tx.piece_hashes(data, starts, ends), starts, ends, word_bounds


def _seeds() -> np.ndarray:
    return tx.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))


def _sliding_minima(values: np.ndarray, widths: list[int]) -> dict[int, np.ndarray]:
    """Minima of each ``width`` consecutive values, for all widths, from shared doubling levels."""
    out: dict[int, np.ndarray] = {}
    level, have = values, 1
    for width in sorted(widths):
        while have * 2 <= width:
            level = np.minimum(level[:-have], level[have:]) if len(level) > have else level[:0]
            have *= 2
        shift = width - have
        out[width] = np.minimum(level[: len(level) - shift], level[shift:]) if shift and len(level) > shift else level[:0] if shift else level
    return out


def _word_hashes(words) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    return _units(data, np.array([0, len(data)]))[0]


class Templates:
    """Shingles, distinguishing words and (when first needed) band keys of the templates."""

    def __init__(self, texts: dict[str, str]):
        self.names = sorted(texts)
        raw = [texts[n].encode() for n in self.names]
        bounds = np.cumsum([0, *map(len, raw)])
        units, starts, ends, first = _units(np.frombuffer(b"".join(raw), np.uint8), bounds)
        whole = b"".join(raw).lower()
        self.size = np.diff(first)
        if len(raw) and self.size.min() < SHINGLE:
            raise ValueError(f"template {self.names[int(self.size.argmin())]} has under {SHINGLE} words")
        telling = _word_hashes(TELLING)
        self.shingles: list[np.ndarray] = []
        self.needed: list[list[np.ndarray]] = []
        self.barred: list[np.ndarray] = []
        for k in range(len(raw)):
            own = units[first[k] : first[k + 1]]
            words = [whole[s:e].decode() for s, e in zip(starts[first[k] : first[k + 1]], ends[first[k] : first[k + 1]])]
            shingles = tx.window_hashes(own, SHINGLE)
            tagged = tuple(words[: len(TAG)]) == TAG
            must = [i for i, w in enumerate(words) if any(c.isdigit() for c in w) or w in TELLING or w in NAMING or tagged and i >= len(TAG)]
            self.needed.append([shingles[max(0, i - SHINGLE + 1) : i + 1] for i in must])
            self.barred.append(np.setdiff1d(telling, own))
            self.shingles.append(np.unique(shingles))
        self._keys: dict[int, np.ndarray] = {}
        self.least = CONTAINED * np.array([len(s) for s in self.shingles])
        every = np.concatenate(self.shingles) if raw else np.empty(0, np.uint64)
        holder = np.repeat(np.arange(len(raw)), [len(s) for s in self.shingles])
        order = np.argsort(every, kind="stable")
        self.every, self.holder = every[order], holder[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.every >> np.uint64(44)] = True

    def keys(self, k: int) -> np.ndarray:
        if k not in self._keys:
            self._keys[k] = np.array([tx.mix(self.shingles[k] ^ s).min() for s in _seeds()], np.uint64)
        return self._keys[k]

    def possible(self, shingles: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Templates of which a block holds enough shingles to contain them at all, and where their shingles are."""
        at = np.flatnonzero(self.seen[shingles >> np.uint64(44)])
        at = at[np.isin(shingles[at], self.every)]
        held = np.isin(self.every, shingles[at])
        count = np.bincount(self.holder[held], minlength=len(self.names))
        chosen = np.flatnonzero((count > 0) & (count >= self.least - 1e-9))
        return chosen.tolist(), at[np.isin(shingles[at], self.every[np.isin(self.holder, chosen)])]


def _candidates(shingles: np.ndarray, templates: Templates) -> dict[int, np.ndarray]:
    """For each possible template, the window starts (in words) whose signature agrees with its own in a band.

    A window that agrees holds a shingle of the template, so only the surroundings of such shingles are looked at.
    """
    chosen, hits = templates.possible(shingles)
    if not chosen:
        return {}
    reach = int(templates.size[chosen].max())
    edge = np.zeros(len(shingles) + 1, np.int32)
    np.add.at(edge, np.maximum(hits - reach, 0), 1)
    np.add.at(edge, np.minimum(hits + reach + 1, len(shingles)), -1)
    near = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    owners: dict[int, list[int]] = {}
    for k in chosen:
        owners.setdefault(int(templates.size[k]) - SHINGLE + 1, []).append(k)
    agree: dict[int, np.ndarray] = {}
    found: dict[int, np.ndarray] = {}
    for h, seed in enumerate(_seeds()):
        minima = _sliding_minima(tx.mix(shingles[near] ^ seed), list(owners))
        for width, own in owners.items():
            for k in own:
                same = minima[width] == templates.keys(k)[h]
                agree[k] = same if h % ROWS == 0 else agree[k] & same
                if h % ROWS == ROWS - 1:
                    found[k] = agree[k] if k not in found else found[k] | agree[k]
    out = {}
    for k, v in found.items():
        width = int(templates.size[k]) - SHINGLE + 1
        at = np.flatnonzero(v)
        at = at[near[at + width - 1] - near[at] == width - 1]  # not over a gap
        held = np.cumsum(np.concatenate([[0], np.isin(shingles[near], templates.shingles[k])]))
        out[k] = near[at[held[at + width] - held[at] >= templates.least[k] - 1e-9]]
    return out


def _contained(units: np.ndarray, shingles: np.ndarray, start: int, k: int, templates: Templates) -> float:
    """Share of the template's shingles in the window, or 0 if a distinguishing word is not in its place."""
    size = int(templates.size[k])
    inside = shingles[start : start + size - SHINGLE + 1]
    share = float(np.isin(templates.shingles[k], inside).mean())
    if share < CONTAINED or np.isin(units[start : start + size], templates.barred[k]).any():
        return 0.0
    return share if share == 1 or all(np.isin(x, inside).any() for x in templates.needed[k]) else 0.0


def scan_block(data: np.ndarray, bounds: np.ndarray, templates: Templates) -> list[tuple[int, str, int, int, float]]:
    """Verified matches: document index, template, first and end byte in the document, containment."""
    units, starts, ends, word_bounds = _units(data, bounds)
    shingles = tx.window_hashes(units, SHINGLE)
    if not len(shingles):
        return []
    matched: list[tuple[int, float, int, int, int]] = []
    for k, at in _candidates(shingles, templates).items():
        size = int(templates.size[k])
        doc = np.searchsorted(word_bounds, at, "right") - 1
        inside = at + size <= word_bounds[doc + 1]
        for start, d in zip(at[inside].tolist(), doc[inside].tolist()):
            if share := _contained(units, shingles, start, k, templates):
                matched.append((-round(share * len(templates.shingles[k])), -share, start, k, d))
    out = []
    taken = np.zeros(len(units), bool)
    for _, share, start, k, d in sorted(matched):  # most shingles first, then the larger share, then leftmost; overlapping windows go
        stop = start + int(templates.size[k])
        if not taken[start:stop].any():
            taken[start:stop] = True
            out.append((d, templates.names[k], int(starts[start] - bounds[d]), int(ends[stop - 1] - bounds[d]), -share))
    return out


@lru_cache(maxsize=4)
def _prepared(texts: tuple[tuple[str, str], ...]) -> Templates:
    return Templates(dict(texts))


def license_matches(df: DataFrame, texts: dict[str, str] | DataFrame | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``df``: ``doc_id`` and its matches (template, first and end byte, containment).

    ``texts`` are the templates by name, or a table of them (``license, text``); it is a small parameter.
    """
    if isinstance(texts, DataFrame):
        texts = {r.license: r.text for r in texts.select("license", "text").collect()}
    chosen = tuple(sorted((licenses.templates() if texts is None else texts).items()))
    kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("contained", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = _prepared(chosen)
        for part, data, bounds in tx.blocks(batches, "text"):
            rows: list[list[dict]] = [[] for _ in range(part.num_rows)]
            for d, name, start, end, share in sorted(scan_block(data, bounds, templates), key=lambda x: (x[0], x[2], x[3], x[1])):
                rows[d].append({"license": name, "start": start, "end": end, "contained": share})
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), pa.array(rows, kind)], ["doc_id", "matches"])

    frame = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return frame.mapInArrow(run, "doc_id long, matches array<struct<license:string,start:long,end:long,contained:double>>")
