r"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds every anchor: at-signs, plus signs,
digits, URL schemes and identifier cues ("iban", "ssn", "account" ...).
Deterministic local parsers then walk left and right from the anchor to the
boundary of the value and validate it. No parser looks further than the run of
characters that can belong to the value, so the work is linear in the text.

Kinds, in listed order (the first four follow the fixed patterns exactly,
leftmost and not overlapping within a kind; a match that fails its check is
consumed and dropped):

* ``email``   ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+``
* ``ip``      four dotted digit runs, each at most 255
* ``card``    digits joined by single spaces or hyphens, 13 to 19 of them, Luhn-valid
* ``phone``   ``\+[0-9][\x20().0-9-]+[0-9]`` with 9 to 15 digits
* ``login``   a URL whose authority carries user information (added)
* ``account`` an identifier right after a cue word, in any ASCII case and not
  inside a longer word, and its qualifier if there is one ("number", "no." ...): an
  IBAN that passes its length and mod 97, or a value of 6 digits or more (added): a
  run of letters and digits with further groups that begin with a digit, joined by
  single hyphens or blanks. Once a value has 6 digits, a blank only goes on with groups
  of at most 5 digits that blanks join already, so a number after a whole identifier
  is not taken along. What stands after "iban" in
  the form of one must be valid

Positions are code points, end exclusive. NULL and empty text have no spans;
repeated rows give repeated results; other columns are left alone.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone", "login", "account")
BASE_KINDS = KINDS[:4]
# Anchor strings (cues in any ASCII case).
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
CUES = ("iban", "ssn", "account", "acct", "passport")
#: What may stand between a cue and its value: a plural, qualifiers, then signs and any run of blanks.
AFTER_CUE = re.compile(r"s?(?:[\x20\t:#=._/-]*(?:numbers?|num|nos?|nr|id|code)(?![A-Za-z0-9]))*[\x20\t:#=.]+", re.ASCII | re.IGNORECASE)
#: Digits of a group of an identifier that is printed in groups, at most.
GROUP = 5
# Lengths of the IBANs of each country (the registry of ISO 13616).
IBAN_LENGTHS = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 "
        "GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 "
        "MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 "
        "UA29 VA22 VG24 XK20 YE30"
    ).split()
}

_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
_AUTHORITY_END = frozenset("/?#\"'<> \t\r\n\v\f")

SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _in_any_case(words: tuple[str, ...]) -> list[str]:
    return ["".join(x) for w in words for x in itertools.product(*((c, c.upper()) for c in w))]


@lru_cache(maxsize=1)
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for text, kind in [("@", "@"), ("+", "+"), *((d, "0") for d in sorted(_DIGITS)), *((s, "scheme") for s in SCHEMES), *((c, len(c)) for c in _in_any_case(CUES))]:
        found.add_word(text, kind)
    found.make_automaton()
    return found


def _run(text: str, at: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _emails(text: str, ats: list[int]) -> Iterator[tuple[int, int]]:
    done = 0
    for at in ats:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = _run(text, at + 1, _LABEL)
        if start == at or end == at + 1:
            continue
        dotted = False
        while text[end : end + 1] == "." and (label := _run(text, end + 1, _LABEL)) > end + 1:
            end, dotted = label, True
        if dotted:
            yield start, end
            done = end


def _chains(text: str, runs: list[tuple[int, int]], joints: str) -> Iterator[list[tuple[int, int]]]:
    """Digit runs linked by one joint character each."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and not (run[0] == chain[-1][1] + 1 and text[chain[-1][1]] in joints):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def _octet(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) < 3 or len(short) == 3 and short <= "255"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _phones(text: str, pluses: list[int]) -> Iterator[tuple[int, int]]:
    done = 0
    for plus in pluses:
        if plus < done or text[plus + 1 : plus + 2] not in _DIGITS:
            continue
        end = _run(text, plus + 2, _PHONE)
        while end > plus + 2 and text[end - 1] not in _DIGITS:
            end -= 1
        if end < plus + 4:  # one character of the class and a last digit after the first
            continue
        if 9 <= sum(c in _DIGITS for c in text[plus:end]) <= 15:
            yield plus, end
        done = end


def _login(text: str, after: int) -> int:
    """End of ``user[:password]@host`` right after a scheme, or -1."""
    end, sign = after, -1
    while end < len(text) and text[end] not in _AUTHORITY_END:
        if text[end] == "@":
            sign = end
        end += 1
    return end if after < sign < end - 1 else -1


def _iban_form(text: str, at: int) -> bool:
    return text[at : at + 2].isascii() and text[at : at + 2].isalpha() and len(text[at : at + 4]) == 4 and text[at + 2] in _DIGITS and text[at + 3] in _DIGITS


def _iban(text: str, at: int) -> int:
    """End of the valid IBAN that begins at ``at``, in one piece or in groups, or -1."""
    length = IBAN_LENGTHS.get(text[at : at + 2].upper())
    taken, end, best = "", at, -1
    while end < len(text) and len(taken) < (length or 34):
        if text[end] in _ALNUM:
            taken += text[end].upper()
            end += 1
            ended = text[end : end + 1] not in _ALNUM  # also at the end of the text
            if ended and (len(taken) == length or not length and len(taken) >= 15) and _mod97(taken) == 1:
                best = end
        elif text[end] in " -" and text[end + 1 : end + 2] in _ALNUM:
            end += 1
        else:
            break
    return best


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _account(text: str, after: int) -> tuple[int, int] | None:
    """The identifier right after a cue word, its qualifiers and separators: an IBAN, or groups with 6 digits or more."""
    if not (between := AFTER_CUE.match(text, after)):
        return None
    at = between.end()
    if _iban_form(text, at):
        if (end := _iban(text, at)) > 0:
            return at, end
        if text[after - 4 : after].lower() == "iban":
            return None
    end = _run(text, at, _ALNUM)
    if end == at:
        return None
    begin, before, digits = at, "", sum(c in _DIGITS for c in text[at:end])
    while (joint := text[end : end + 1]) in ("-", " ") and text[end + 1 : end + 2] in _DIGITS:
        group = _run(text, end + 1, _ALNUM)
        if digits >= 6 and joint == " ":
            short = end - begin <= GROUP and group - end - 1 <= GROUP and _run(text, end + 1, _DIGITS) == group
            if before != " " or not short:
                break
        digits += sum(c in _DIGITS for c in text[end + 1 : group])
        begin, before, end = end + 1, joint, group
    return (at, end) if digits >= 6 else None


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of one text, by kind as listed, then start."""
    if not text:
        return []
    ats: list[int] = []
    pluses: list[int] = []
    runs: list[tuple[int, int]] = []
    schemes: list[int] = []
    cues: list[int] = []
    begin = end = -1
    for last, kind in _anchors().iter(text):
        if kind == "0":
            if last == end:
                end += 1
            else:
                if begin >= 0:
                    runs.append((begin, end))
                begin, end = last, last + 1
        elif kind == "@":
            ats.append(last)
        elif kind == "+":
            pluses.append(last)
        elif kind == "scheme":
            schemes.append(last + 1)
        elif last < kind or text[last - kind] not in _ALNUM:  # a cue, known by its length, that begins a word
            cues.append(last + 1)
    if begin >= 0:
        runs.append((begin, end))
    found = [("email", s, e) for s, e in _emails(text, ats)] if ats else []
    if runs:
        for chain in _chains(text, runs, "."):
            for i in range(0, len(chain) - 3, 4):
                if all(_octet(text[s:e]) for s, e in chain[i : i + 4]):
                    found.append(("ip", chain[i][0], chain[i + 3][1]))
        for chain in _chains(text, runs, " -"):
            if 13 <= sum(e - s for s, e in chain) <= 19 and _luhn("".join(text[s:e] for s, e in chain)):
                found.append(("card", chain[0][0], chain[-1][1]))
    found += [("phone", s, e) for s, e in _phones(text, pluses)] if pluses else []
    found += [("login", s, e) for s in schemes if (e := _login(text, s)) > 0]
    accounts = dict.fromkeys(_account(text, c) for c in cues)
    found += [("account", *x) for x in accounts if x]
    return found


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with each span (overlapping ones as one, under the first's kind) replaced by ``<KIND>``."""
    if not spans:
        return text
    out, at, kind, begin, stop = [], 0, "", -1, -1
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s < stop:
            stop = max(stop, e)
            continue
        if kind:
            out += [text[at:begin], f"<{kind.upper()}>"]
            at = stop
        kind, begin, stop = k, s, e
    out += [text[at:begin], f"<{kind.upper()}>", text[stop:]]
    return "".join(out)


def with_pii(df: DataFrame, text: str = "text", spans: str = "pii_spans", redacted: str | None = None) -> DataFrame:
    """``df`` with a column of spans and, if ``redacted`` is named, one of the redacted text (it may be ``text`` itself).

    Spark partitions the rows; nothing is shuffled. A NULL text keeps a NULL
    redacted text and an empty list of spans. A column that already has one of
    the new names is replaced.
    """
    fields = [f for f in df.schema.fields if f.name not in (redacted, spans)]
    added = [T.StructField(spans, SPAN_TYPE), *([T.StructField(redacted, T.StringType())] if redacted else [])]
    schema = T.StructType([*fields, *added])
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = [find_spans(t) for t in texts]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            columns.append(pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in found], _SPAN_ARROW))
            if redacted:
                columns.append(pa.array([redact(t, x) for t, x in zip(texts, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*names, spans, *([redacted] if redacted else [])])

    out = df.mapInArrow(run, schema)
    return out.select(*df.columns, *[f.name for f in added if f.name not in df.columns])


def span_digest(spans: str, kinds: tuple[str, ...]) -> "F.Column":
    """``kind:start:end`` of the spans of some kinds, comma-joined (they come sorted by kind, then start)."""
    kept = F.filter(F.col(spans), lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def pii_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: counts by base kind and digests of the spans."""
    found = with_pii(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", "found")
    n = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[n(k) for k in BASE_KINDS], F.sha2(span_digest("found", BASE_KINDS), 256).alias("base_sha256"), span_digest("found", KINDS).alias("spans"))
