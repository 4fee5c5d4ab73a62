"""Secret scans with corpus-wide ownership frequency.

A scan of every whole text finds candidates. Base kinds are always reported. The method adds
private-key blocks and long random-looking tokens, and judges every candidate by who holds it:
a value that many owners or many repositories carry is a widely copied example, one that few
carry is a live-looking credential. Added kinds are reported only where they look live.

Only hashes of values move. Distinct (value, owner, repository) triples are counted in steps
with partial sums, so a value that a third of all documents carry becomes a few numbers per
task; the counts are stored and joined by plain shuffles, which adaptive execution can split.

Null or empty text: no span. A null owner or repository is one of its own. Repeated rows count
as one repository and get one row each. An empty table gives an empty result. Positions are
code points, ends exclusive. Texts are scanned whole, however long.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import first_of
from talentlake.workspace import stored

# Base kinds in their order, patterns and least lengths.
KINDS = ["assign", "access", "hex", "key", "token"]
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

KEY = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[^-]*-----END [A-Z ]*PRIVATE KEY-----)?")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
TOKEN_ENTROPY = 3.5  # bits per character
MARK = "[secret]"
MAX_OWNERS = 2
MAX_REPOSITORIES = 9

SPAN = "array<struct<kind:int,start:int,end:int,value:bigint>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.int64())])
)


def _random_looking(value: str) -> bool:
    """Upper and lower case, digits, and many different characters."""
    if not (re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= TOKEN_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, value) of every candidate, by start, then kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                found.append((0, m.start(), m.end(), m[2]))
    if "AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    taken = [(start, end) for _, start, end, _ in found]
    if "PRIVATE KEY" in text:
        found += [(3, m.start(), m.end(), m[0]) for m in KEY.finditer(text)]
        taken += [(start, end) for kind, start, end, _ in found if kind == 3]
    taken.sort()
    starts = [start for start, _ in taken]
    reach = list(accumulate((end for _, end in taken), max))  # of a span and all that start before it
    for m in TOKEN.finditer(text):
        if _random_looking(m[0]):
            before = bisect_left(starts, m.end())
            if not (before and reach[before - 1] > m.start()):
                found.append((4, m.start(), m.end(), m[0]))
    return sorted(found, key=lambda x: (x[1], x[0], x[2]))


def _scan(texts: pa.Array) -> pa.Array:
    def spans(text: str | None) -> list[dict[str, int]]:
        return [
            {"kind": kind, "start": start, "end": end, "value": xxhash.xxh64_intdigest(value) - 2**63}
            for kind, start, end, value in (candidates(text) if text else [])
        ]

    return pa.array([spans(text.as_py()) for text in texts], type=_ARROW)


def cover(text: str, spans: list[tuple[int, int]]) -> str:
    """A text with every span, given by start, replaced; overlapping ones become one."""
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], MARK]
        at = max(at, end)
    return "".join(out) + text[at:]


def _covered(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array(
        [cover(t.as_py(), [tuple(s.values()) for s in own.as_py()]) for t, own in zip(texts, spans)], pa.string()
    )


def scan(text: Column) -> Column:
    """Candidates of a text as an array of (kind, start, end, hash of the value)."""
    return F.arrow_udf(_scan, SPAN)(text)


def ownership(scanned: DataFrame, spans: str, owner: str, repository: str) -> DataFrame:
    """Per candidate value its distinct owners and repositories; a repository is an owner's."""
    return (
        scanned.select(
            F.explode(f"{spans}.value").alias("value"),
            F.col(owner).alias("owner"),
            F.col(repository).alias("repository"),
        )
        .distinct()
        .groupBy("value", "owner")
        .agg(F.count("*").alias("repositories"))
        .groupBy("value")
        .agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    )


def _live(max_owners: int, max_repositories: int) -> Column:
    return (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)


def _judged(scanned: DataFrame, key: str, spans: str, owner: str, repository: str, limits: tuple[int, int]) -> DataFrame:
    """Per key of a stored scan its spans with ``live``, by start, then kind."""
    counts = stored(ownership(scanned, spans, owner, repository), "ownership")
    each = scanned.select(F.col(key).alias("key"), F.inline(spans))
    return (
        each.join(counts, "value")
        .select(
            "key",
            F.struct("start", "kind", "end", _live(*limits).alias("live"), "owners", "repositories").alias("span"),
        )
        .groupBy("key")
        .agg(F.array_sort(F.collect_list("span")).alias("spans"))
    )


def secrets(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """One row per document with ``spans``: array of (kind, start, end, live, owners,
    repositories), base kinds always, added kinds only where they look live."""
    scanned = stored(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(owner).alias("owner"),
            F.col(repository).alias("repository"),
            scan(F.col(text)).alias("found"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "scanned",
    )
    judged = _judged(scanned, "row", "found", "owner", "repository", (max_owners, max_repositories))
    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(
        F.filter(F.coalesce("spans", F.array()), lambda s: (s["kind"] < 3) | s["live"]),
        lambda s: F.struct(
            F.get(names, s["kind"]).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            s["live"].alias("live"),
            s["owners"].alias("owners"),
            s["repositories"].alias("repositories"),
        ),
    )
    return (
        scanned.select("row", "doc_id")
        .join(judged.withColumnRenamed("key", "row"), "row", "left")
        .select("doc_id", spans.alias("spans"))
    )


def redact(
    docs: DataFrame,
    text: str = "text",
    owner: str = "source",
    repository: str = "doc_id",
    size: str | None = None,
    max_owners: int = MAX_OWNERS,
    max_repositories: int = MAX_REPOSITORIES,
) -> DataFrame:
    """``docs``, all rows and columns, with every live-looking secret replaced by
    ``[secret]``. Only texts with candidates are joined to their verdicts. ``size`` names a
    column that holds the text's length."""
    name = first_of(["found", "row_key", "key", "spans", "covered"], docs.columns)
    found, row = name["found"], name["row_key"]
    scanned = docs.withColumn(found, F.coalesce(scan(F.col(text)), F.array().cast(SPAN)))
    clean = scanned.where(F.size(found) == 0).drop(found)
    held = stored(scanned.where(F.size(found) > 0).withColumn(row, F.monotonically_increasing_id()), "candidates")
    judged = _judged(held, row, found, owner, repository, (max_owners, max_repositories)).select(
        F.col("key").alias(row), F.filter("spans", lambda s: s["live"]).alias(name["spans"])
    )
    spans = F.col(name["spans"])

    covered = name["covered"]
    new_text = F.arrow_udf(_covered, "string")(F.col(text), F.transform(spans, lambda s: F.struct(s["start"], s["end"])))
    any_live = F.size(spans) > 0
    columns = [F.col(covered).alias(c) if c == text else F.col(c) for c in docs.columns]
    if size:
        length = F.when(any_live, F.length(covered).cast(docs.schema[size].dataType)).otherwise(F.col(size))
        columns[docs.columns.index(size)] = length.alias(size)
    return clean.unionByName(held.join(judged, row).withColumn(covered, new_text).select(*columns))
