r"""Secret scans with multipart credential linking, in DataFrame operations only.

Strong parts are reported wherever they stand:

* ``assign``  a keyword, a sign and a value of six characters or more
* ``access``  ``AKIA[A-Z0-9]+`` of 20 characters or more
* ``hex``     ``[0-9a-f]+`` of 24 characters or more

Weak parts say little alone and are reported only if a complementary part
stands within ``SCOPE`` code points of them in the same document:

* ``ident``    a user, login or client id assignment: needs a secret nearby
* ``blob``     a base-64 word of 40 characters or more (and its padding) with upper, lower case and digits: needs an identifier or an endpoint nearby
* ``endpoint`` a URL of a service that takes credentials: needs a secret nearby

A regular expression's matches and the gaps between them are taken from one text
with ``regexp_extract_all`` and ``split``; running sums of their lengths give
positions in code points. Parts meet in an interval join: both sides are cut into
scope-sized bins and joined on (row, bin), so a document with very many parts is
spread over its bins and no pairs are made outside a scope.

Defined results: NULL and empty text have no parts; repeated rows each get their
own result; only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm import text as tx

#: Code points between linked parts, at most.
SCOPE = 300

# Patterns of the strong parts.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_HINT = r"(?i:password|passwd|secret|token|api_?key)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Patterns of the weak parts.
IDENT = r"(?i:user(?:name)?|login|client_?id|account_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._@+-]{3,}"
IDENT_HINT = r"(?i:user|login|client_?id|account_?id|access_?key_?id)[a-zA-Z]{0,4}[\"']?\x20*[:=]"
BLOB = r"(?<![A-Za-z0-9+/=])(?=[a-z0-9+/]*+[A-Z])(?=[A-Z0-9+/]*+[a-z])(?=[A-Za-z+/]*+[0-9])[A-Za-z0-9+/]{40,}+={0,2}(?![A-Za-z0-9+/=])"
BLOB_HINT = r"[A-Za-z0-9+/]{40}"
ENDPOINT = r"(?:https?|ftps?|sftp|ssh|jdbc:[a-z0-9]{2,}(?::[a-z0-9]{2,})?|rediss?|mongodb(?:[+]srv)?|postgres|postgresql|mysql|mariadb|mssql|amqps?|mqtts?|ldaps?|smtps?|imaps?|s3)://[A-Za-z0-9._~:/?#@!&*+,;=%-]{3,}"

BASE = ("assign", "access", "hex")
SECRETS = ("assign", "hex", "blob")
IDENTIFIERS = ("access", "ident", "endpoint")
#: What each weak kind must stand near to.
PARTNERS = {"ident": SECRETS, "blob": IDENTIFIERS, "endpoint": SECRETS}
KINDS = (*BASE, *PARTNERS)


def _pieces(text: Column, pattern: str, worth: Column) -> Column:
    """Matches of a pattern with the code points before each since the last match; empty where ``worth`` is false."""
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kind = "array<struct<gap:int,found:string>>"
    zipped = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("found")), lambda x: F.struct(x["gap"].alias("gap"), x["found"].alias("found")))
    return F.when(worth, zipped.cast(kind)).otherwise(F.array().cast(kind))


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One pass over the texts, written: ``row``, ``doc_id`` and the matches of each kind."""
    t = F.col("text")
    has = {
        "assign": (ASSIGN, t.rlike(ASSIGN_HINT)),
        "access": (ACCESS, t.contains("AKIA")),
        "hex": (HEX, t.rlike(HEX)),
        "ident": (IDENT, t.rlike(IDENT_HINT)),
        "blob": (BLOB, t.rlike(BLOB_HINT)),
        "endpoint": (ENDPOINT, t.contains("://")),
    }
    base = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = base.select(F.monotonically_increasing_id().alias("row"), "doc_id", *[_pieces(t, p, worth).alias(k) for k, (p, worth) in has.items()])
    return tx.written(rows, "secret-parts")


def parts(scanned: DataFrame) -> DataFrame:
    """``row, kind, start, end`` of every part, strong or weak (a match that fails its check is dropped here)."""
    kinds = []
    for kind in KINDS:
        own = scanned.where(F.size(kind) > 0).select("row", F.posexplode(kind).alias("at", "part"))
        so_far = F.sum(F.col("part.gap") + F.length("part.found")).over(Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        own = own.select("row", F.lit(kind).alias("kind"), "part.found", so_far.alias("end"))
        if kind == "assign":
            own = own.where(F.length(F.regexp_extract("found", ASSIGN, 2)) >= 6)
        kinds.append(own.select("row", "kind", (F.col("end") - F.length("found")).alias("start"), "end"))
    return reduce(DataFrame.unionByName, kinds)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts that have a complementary part within ``scope``, by an interval join on bins."""
    needs = F.create_map(*[x for k, v in PARTNERS.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in v]))])
    weak = found.where(F.col("kind").isin(*PARTNERS))
    wide = weak.select("row", "kind", "start", "end", F.explode(F.sequence(F.floor(F.greatest(F.col("start") - scope, F.lit(0)) / scope), F.floor((F.col("end") + scope) / scope))).alias("bin"))
    near = found.select(F.col("row").alias("near_row"), F.col("kind").alias("near_kind"), F.col("start").alias("near_start"), F.col("end").alias("near_end"))
    near = near.withColumn("near_bin", F.explode(F.sequence(F.floor(F.col("near_start") / scope), F.floor(F.col("near_end") / scope))))
    meets = (
        (F.col("row") == F.col("near_row")) & (F.col("bin") == F.col("near_bin"))
        & F.array_contains(needs[F.col("kind")], F.col("near_kind"))
        & (F.col("near_start") <= F.col("end") + scope) & (F.col("near_end") >= F.col("start") - scope)
    )
    return wide.join(near, meets, "left_semi").select("row", "kind", "start", "end").distinct()


def secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row for each document: ``doc_id`` and its spans ``(start, place, kind, end)`` in order; ``place`` is the kind's."""
    scanned = scan(df, doc_id, text)
    found = tx.written(parts(scanned), "secret-found")
    kept = found.where(F.col("kind").isin(*BASE)).unionByName(linked(found, scope))
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int").alias("place")
    spans = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", place, "kind", "end"))).alias("spans"))
    return scanned.select("row", "doc_id").join(spans, "row", "left").select("doc_id", "spans")


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of the spans of some kinds, comma-joined."""
    own = F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.coalesce(F.array_join(F.transform(own, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","), F.lit(""))


def secret_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the strong kinds and digests of the spans, one row for each document."""
    found = secrets(df, doc_id, text)
    spans = F.col("spans")
    n = lambda kind: F.coalesce(F.size(F.filter(spans, lambda x: x["kind"] == kind)), F.lit(0))
    count = lambda kind: F.when(spans.isNull(), F.lit(0)).otherwise(n(kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(digest(spans, BASE), 256).alias("base_sha256"), digest(spans, KINDS).alias("spans"))
