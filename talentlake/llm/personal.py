"""Personal data by bootstrapped contextual extraction.

Exact base patterns (email, ip, card, phone) give the seed entities. What stands before a seed,
its last two words or the label glued to it, is a lexical pattern; so is what stands before any
other token that looks like an identifier. Patterns and values are the two sides of a graph.
Spark scores it iteratively: a pattern's confidence is the share of its occurrences in the
corpus that known values follow; ordinary words after it count against it in full, values not
known yet by ``UNKNOWN`` each. A value is believed if confident patterns precede it, and believed
values count as known in the next round. Patterns need
``min_values`` distinct known values, so copies of one text prove nothing. In the end every
occurrence of a believed value is a span of kind ``context``, beside the base spans, which stay.

Two passes read the texts: one scans, one counts the patterns that have enough values to matter
(they are found by a bitmap of fixed size, then joined exactly). Values and patterns move as
hashes, and are added up in steps with partial sums, so a value or pattern that a third of all
rows share is a few numbers per task.

Null or empty text: no spans. Null ids and repeated rows: one row each. Positions are code points,
ends exclusive. Texts are read whole, in time linear in their length. Where kinds start at one
place they come in the order of ``KINDS``. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.collocations import bitmap, in_bitmap
from talentlake.llm.frames import map_slices
from talentlake.llm.shingles import REMEMBERED_WORDS, mixed
from talentlake.workspace import stored

KINDS = ["email", "ip", "card", "phone", "context"]
CONTEXT = 4
MIN_VALUES = 3
MIN_CONFIDENCE = 0.8
ROUNDS = 3
UNKNOWN = 0.25
LEAST_DIGITS = 4
LEAST_LENGTH = 6
LABEL_LENGTH = 64  # characters of a token in which its label, or what else is glued to a value, ends

# The base patterns and their limits. Written so that no run is read twice: a match
# never starts inside a run of digits, and an address is found from its at sign.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
IP_MOST = 255
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
CARD_DIGITS = range(14, 20)
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
PHONE_DIGITS = range(10, 16)

_HINT = re.compile("[0-9@]")
_TOKEN = re.compile(r"\S+")
_IDENTIFIER = re.compile(r"(?<!\S)\S*[0-9@]\S*")
_OPENING, _CLOSING = "\"'([{<", "\"')]}>.,;:!?"
_MARKS = re.compile("[:=#]")
_DIGITS = str.maketrans("123456789", "0" * 9)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LABEL = np.uint64(0xD6E8FEB86659FD93)  # sets hashes of labels apart from those of word pairs

SPAN = "array<struct<kind:int,start:int,end:int,value:bigint,patterns:array<bigint>>>"
_ARROW = pa.list_(
    pa.struct(
        [
            ("kind", pa.int32()),
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("value", pa.int64()),
            ("patterns", pa.list_(pa.int64())),
        ]
    )
)


def emails(text: str) -> list[tuple[int, int]]:
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        before = text[end:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            found.append((at - local, domain.end()))
            end = domain.end()
        else:
            end = at + 1
        at = text.find("@", end)
    return found


def _small(part: str) -> bool:
    digits = part.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= IP_MOST


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def _count_digits(text: str) -> int:
    return sum(map(text.count, "0123456789"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds, by start, then kind."""
    if not _HINT.search(text):
        return []
    found = [(start, 0, end) for start, end in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(map(_small, m[0].split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS.start:
            digits = m[0].replace(" ", "").replace("-", "")
            if len(digits) in CARD_DIGITS and luhn(digits):
                found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if _count_digits(m[0]) in PHONE_DIGITS:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def identifiers(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Where tokens look like identifiers, without a glued label, and no base span lies."""
    found = []
    ends, reach = [], 0  # of the base spans so far, for texts with many of them
    starts = [start for start, _, _ in base]
    for _, _, end in base:
        reach = max(reach, end)
        ends.append(reach)
    for m in _IDENTIFIER.finditer(text):
        start, end = m.span()
        marks = [x.end() for x in _MARKS.finditer(m[0].rstrip(_CLOSING))]
        body = m[0][marks[-1] if marks else 0 :]
        start = end - len(body)
        start += len(body) - len(body.lstrip(_OPENING))
        value = text[start:end].rstrip(_CLOSING)
        end = start + len(value)
        at = value.find("@")
        if len(value) < LEAST_LENGTH or not (_count_digits(value) >= LEAST_DIGITS or 0 < at < len(value) - 1):
            continue
        before = bisect_right(starts, end - 1)
        if not (before and ends[before - 1] > start):
            found.append((start, end))
    return found


def normal(token: str) -> str:
    return token.lower().translate(_DIGITS)


def label_of(token: str) -> str:
    """A token up to its first mark (colon, equals sign or hash sign); empty without one, or if
    that is too far away."""
    mark = _MARKS.search(token, 0, LABEL_LENGTH)
    return normal(token[: mark.end()].lstrip(_OPENING)) if mark else ""


def _digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


class _Tokens(dict):
    """Hash of a token's normal form, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED_WORDS // 4:
            self.clear()
        self[token] = value = _digest(normal(token))
        return value


class _Labels(dict):
    """Hash of a token's label, 0 without one, remembered up to a bound."""

    def __missing__(self, token: str) -> int:
        if len(self) > REMEMBERED_WORDS // 4:
            self.clear()
        label = label_of(token)
        self[token] = value = int(_label_hash(_digest(label))) if len(label) > 1 else 0
        return value


def _label_hash(digest: int | np.ndarray) -> np.ndarray:
    return mixed(np.asarray(digest, dtype=np.uint64) ^ _LABEL)


_tokens, _labels = _Tokens(), _Labels()  # of this worker


def _hashes(cache: dict, tokens: list[str]) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def _pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first * _STEP + second)


def patterns(text: str, places: list[int]) -> list[list[int]]:
    """Per place in a text the patterns that stand before it, as hashes."""
    spans = [m.span() for m in _TOKEN.finditer(text)]
    starts = [start for start, _ in spans]
    out = []
    for place in places:
        own = bisect_right(starts, place) - 1
        if place - starts[own] > LABEL_LENGTH:
            out.append([])
            continue
        glue = text[starts[own] : place].lstrip(_OPENING)
        before = [text[a:b] for a, b in spans[max(0, own - 2) : own]]
        found = []
        label = ""
        if glue:
            if label_of(glue) and _MARKS.search(glue).end() == len(glue):
                label = label_of(glue)
        elif before:
            last = before[-1].lstrip(_OPENING)
            if label_of(last) and _MARKS.search(last).end() == len(last):
                label = label_of(last)
            if len(before) == 2:
                pair = _hashes(_tokens, before)
                found.append(int(_pair_hash(pair[:1], pair[1:]).view(np.int64)[0]))
        if len(label) > 1:
            found.append(int(_label_hash(_digest(label)).astype(np.uint64).view(np.int64)))
        out.append(found)
    return out


def scan(text: str) -> list[dict[str, object]]:
    """Base spans and identifier-like tokens of a text. A token's patterns are given once, for
    its first span."""
    if not _HINT.search(text):
        return []
    base = base_spans(text)
    found = sorted(base + [(start, CONTEXT, end) for start, end in identifiers(text, base)])
    if not found:
        return []
    before = patterns(text, [start for start, _, _ in found])
    seen = set()
    out = []
    for (start, kind, end), own in zip(found, before):
        out.append(
            {
                "kind": kind,
                "start": start,
                "end": end,
                "value": _digest(text[start:end].lower()) - 2**63,
                "patterns": [] if start in seen else own,
            }
        )
        seen.add(start)
    return out


def _scan(texts: pa.Array) -> pa.Array:
    return pa.array([scan(text) if (text := t.as_py()) else [] for t in texts], type=_ARROW)


def pattern_totals(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(pattern, total): how often each wanted pattern occurs in all texts, whatever follows it."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "pattern"))

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        found = []
        for t in batch.column("text").to_pylist():
            tokens = t.split() if t else []
            hashes = _hashes(_tokens, tokens)
            if len(tokens) > 2:
                pairs = _pair_hash(hashes[:-2], hashes[1:-1])
                found.append(pairs[in_bitmap(shared.value, pairs)])
            if t and _MARKS.search(t):
                labels = _hashes(_labels, tokens)
                labels = labels[labels > 0]
                found.append(labels[in_bitmap(shared.value, labels)])
        value, n = np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.uint64), return_counts=True)
        return {"pattern": pa.array(value.view(np.int64)), "total": pa.array(n.astype(np.int64))}

    counted = map_slices(docs.select(F.col(text).alias("text")), run, "pattern bigint, total bigint")
    return counted.groupBy("pattern").agg(F.sum("total").alias("total")).join(wanted, "pattern")


def believed(edges: DataFrame, totals: DataFrame, min_values: int, min_confidence: float, rounds: int) -> DataFrame:
    """(value) that confident patterns precede and that is no seed. ``edges`` holds (pattern,
    value, n, seed)."""
    graph = stored(edges.join(totals, "pattern"), "graph")
    known = stored(graph.where("seed").select("value", F.lit(1.0).alias("belief")).distinct(), "beliefs")
    for _ in range(rounds):
        weighed = graph.join(known, "value", "left").withColumn("belief", F.coalesce("belief", F.lit(0.0)))
        confident = (
            weighed.groupBy("pattern", "total")
            .agg(
                F.sum(F.col("n") * F.col("belief")).alias("known"),
                F.sum("n").alias("all"),
                F.count_if(F.col("belief") >= min_confidence).alias("values"),
            )
            .withColumn("against", F.greatest(F.col("total") - F.col("all"), F.lit(0)) + UNKNOWN * (F.col("all") - F.col("known")))
            # One more occurrence against it, so that few of them are no proof.
            .withColumn("confidence", F.least(F.col("known") / (F.col("known") + F.col("against") + 1), F.lit(0.999)))
            .where((F.col("confidence") >= min_confidence) & (F.col("values") >= min_values))
            .select("pattern", "confidence")
        )
        confident = stored(confident, "confident")
        doubt = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        found = (
            graph.where("not seed").join(confident, "pattern").groupBy("value").agg((1 - doubt).alias("belief"))
        )
        seeds = graph.where("seed").select("value", F.lit(1.0).alias("belief")).distinct()
        known = stored(seeds.union(found.join(seeds, "value", "left_anti")), "beliefs")
    return (
        known.join(graph.where("seed").select("value").distinct(), "value", "left_anti")
        .where(F.col("belief") >= min_confidence)
        .select("value")
    )


def personal_data(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_values: int = MIN_VALUES,
    min_confidence: float = MIN_CONFIDENCE,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document with ``spans``: array of (start, kind, end), ``kind`` a place in
    ``KINDS``, by start, then kind."""
    scanned = stored(
        docs.select(F.col(doc_id).alias("doc_id"), F.arrow_udf(_scan, SPAN)(F.col(text)).alias("found")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "scanned",
    )
    each = scanned.select("row", F.inline("found"))
    edges = stored(
        each.select("value", (F.col("kind") != CONTEXT).alias("seed"), F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value")
        .agg(F.count("*").alias("n"), F.bool_or("seed").alias("seed")),
        "edges",
    )
    wanted = stored(
        edges.groupBy("pattern").agg(F.count("*").alias("values")).where(F.col("values") >= min_values).select("pattern"),
        "wanted",
    )
    totals = pattern_totals(docs, text, wanted)
    values = believed(edges, totals, min_values, min_confidence, rounds)
    span = F.struct("start", "kind", "end")
    added = (
        each.where(F.col("kind") == CONTEXT)
        .join(values, "value")
        .groupBy("row")
        .agg(F.collect_list(span).alias("added"))
    )
    base = F.transform(
        F.filter("found", lambda s: s["kind"] != CONTEXT),
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
    )
    return scanned.join(added, "row", "left").select(
        "doc_id", F.array_sort(F.concat(base, F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>")))).alias("spans")
    )
