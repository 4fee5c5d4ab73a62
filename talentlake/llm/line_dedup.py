"""Line dedup by a deletion-neighbourhood join, within one edited word in eight.

A line is removed if an earlier line of the corpus is the same but for its edits: one word
inserted, deleted or replaced if both lines have ``min_words`` words or more, none if one of them
is shorter, since a word is too much of it. Lines are compared by their lower-case words; lines
without a word are left alone. The earlier line is the one of the lesser document id, then of the
lesser hash of the text, then of the lesser line number. Of equal lines the first stays.

Every line with a possible neighbour emits the hashes of its variants with one word left out.
Two lines of equal length within the bound share a variant at the same position; a line that
lacks a word of another is that one's variant. In each group of equal variants all lines are
paired with the earliest only, so a family of thousands of lines costs rows in proportion, and
pairs are verified on their words.

Variants are many, so an exact filter comes first: lines within the bound share their first or
their last half, so only lines with a half that another line has emit variants, and only those
whose left-out word lies in the other half. Halves, variants and lines move as hashes; texts
move once, to fetch the lines that the filter left.

Null or empty text: no line. Null ids come after all others. Rows repeated as a whole are
treated alike. Texts and lines of any length are read whole; a line's variants are computed
from running sums. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import first_of, map_slices, same, text_hash, texts_of, typed
from talentlake.llm.shingles import mixed, word_hashes
from talentlake.workspace import discard, stored

MIN_WORDS = 8  # of lines that may differ by a word
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
FRONT, BACK = 1, 2  # the half that a live key leaves to the edit


class _Powers:
    """Powers of the base and of its inverse, modulo 2^64, up to the longest line so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = max(1024, 2 * n)
            steps = np.full(size, _BASE, dtype=np.uint64), np.full(size, _INVERSE, dtype=np.uint64)
            steps[0][0] = steps[1][0] = 1
            self.up, self.down = (np.multiply.accumulate(s) for s in steps)
        return self.up, self.down


_powers = _Powers()


class Hashed:
    """Running sums over the words of many lines, and hashes that follow from them."""

    def __init__(self, lines: list[list[str]]):
        self.n = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
        self.start = np.concatenate([[0], np.cumsum(self.n)]).astype(np.int64)[:-1]
        words = word_hashes([word for line in lines for word in line])
        self.up, self.down = _powers.upto(int(self.n.max(initial=0)) + 1)
        place = np.arange(len(words)) - np.repeat(self.start, self.n)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.up[place], dtype=np.uint64)])

    @staticmethod
    def key(total: np.ndarray, n: np.ndarray, tag: int) -> np.ndarray:
        return mixed(total + mixed(n.astype(np.uint64) * np.uint64(8) + np.uint64(tag))).view(np.int64)

    def whole(self) -> np.ndarray:
        return self.key(self.sums[self.start + self.n] - self.sums[self.start], self.n, 0)

    def prefix(self, size: np.ndarray) -> np.ndarray:
        return self.key(self.sums[self.start + size] - self.sums[self.start], size, BACK)

    def suffix(self, size: np.ndarray) -> np.ndarray:
        left = self.n - size
        total = self.sums[self.start + self.n] - self.sums[self.start + left]
        return self.key(total * self.down[left], size, FRONT)

    def variants(self, line: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Hash of each line without the word at the place; equals the hash of that shorter line."""
        start, n = self.start[line], self.n[line]
        before = self.sums[start + place] - self.sums[start]
        after = (self.sums[start + n] - self.sums[start + place + 1]) * np.uint64(_INVERSE)
        return self.key(before + after, n - 1, 0)


def line_words(line: str) -> list[str]:
    return line.lower().split()


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word inserted, deleted or replaced, or none, turns one line into the other."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    rest_a, rest_b = a[i:], b[i:]
    if len(a) == len(b):
        return rest_a[1:] == rest_b[1:]
    return rest_a[1:] == rest_b if len(a) > len(b) else rest_a == rest_b[1:]


def read_lines(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """Per line with a word: the document's key, its number, ``node`` (hash of its words) and, of
    lines with enough words for an edit, the hashes of its halves."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        owner, number, lines = [], [], []
        for i, body in enumerate(texts_of(batch)):
            for k, line in enumerate(body.split("\n")):
                words = line_words(line)
                if words:
                    owner.append(i)
                    number.append(k)
                    lines.append(words)
        hashed = Hashed(lines)
        half = hashed.n // 2
        # Lines of even length also emit halves one shorter, to meet those with a word less.
        size = np.where(hashed.n % 2 == 0, half - 1, half)
        keys = np.stack([hashed.prefix(half), hashed.suffix(half), hashed.prefix(size), hashed.suffix(size)], axis=1)
        taken = np.where(hashed.n < min_words, 0, np.where(hashed.n % 2 == 0, 4, 2))
        flat = keys.ravel()[(np.arange(4)[None, :] < taken[:, None]).ravel()]
        offsets = np.concatenate([[0], np.cumsum(taken)]).astype(np.int32)
        at = pa.array(owner, type=pa.int64())
        return {
            "doc_id": batch.column("doc_id").take(at),
            "text_hash": batch.column("text_hash").take(at),
            "line": pa.array(number, type=pa.int32()),
            "node": pa.array(hashed.whole(), type=pa.int64()),
            "halves": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int64())),
        }

    read = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    schema = f"doc_id {typed(read, 'doc_id')}, text_hash bigint, line int, node bigint, halves array<bigint>"
    return map_slices(read, run, schema)


def _order() -> Column:
    """What says which line is the earlier one."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "line")


def _variants(lines: DataFrame) -> DataFrame:
    """Rows (variant, place, node) of lines (node, sides, line_text); place -1 is the line itself."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        words = [line_words(line) for line in batch.column("line_text").to_pylist()]
        hashed = Hashed(words)
        sides = batch.column("sides").to_numpy(zero_copy_only=False)
        line = np.repeat(np.arange(len(words)), hashed.n)
        place = np.arange(len(line)) - np.repeat(hashed.start, hashed.n)
        half = hashed.n[line] // 2
        # An edit beyond a shared first half lies at or after the shorter half's end, and so on.
        wanted = ((sides[line] & BACK) > 0) & (place >= half - 1) | ((sides[line] & FRONT) > 0) & (place <= hashed.n[line] - half)
        line, place = line[wanted], place[wanted]
        node = batch.column("node").to_numpy()
        return {
            "variant": np.concatenate([hashed.whole(), hashed.variants(line, place)]),
            "place": np.concatenate([np.full(len(words), -1), place]).astype(np.int32),
            "node": np.concatenate([node, node[line]]),
        }

    return map_slices(lines, run, "variant bigint, place int, node bigint")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Nodes of the pairs (node, earlier) whose words are within the bound."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        good = [
            within_one(line_words(a), line_words(b))
            for a, b in zip(batch.column("line_text").to_pylist(), batch.column("earlier_text").to_pylist())
        ]
        return {"node": batch.column("node").filter(pa.array(good, type=pa.bool_()))}

    earlier = texts.select(F.col("node").alias("earlier"), F.col("line_text").alias("earlier_text"))
    both = pairs.join(texts, "node").join(earlier, "earlier").select("node", "line_text", "earlier_text")
    return map_slices(both, run, "node bigint").distinct()


def _near(docs: DataFrame, lines: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, list[DataFrame]]:
    """Nodes of distinct lines (node, first, halves) that have an earlier line within the bound,
    and the stored tables that this reads."""
    halves = lines.select("node", F.posexplode("halves").alias("which", "half"))
    shared = stored(
        halves.groupBy("half").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a != b").select("half"),
        "shared_halves",
    )
    side = F.when(F.col("which") % 2 == 0, BACK).otherwise(FRONT)
    live = halves.join(shared, "half").groupBy("node").agg(F.bit_or(side).alias("sides"))
    firsts = lines.select("node", "first")
    wanted = (
        live.join(firsts, "node")
        .groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash"))
        .agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "node", "sides")).alias("wanted"))
    )
    read = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    fetched = stored(
        read.join(wanted, same(read, wanted, "doc_id", "text_hash"))
        .select(F.split("text", "\n").alias("all"), F.inline("wanted"))
        .select("node", "sides", F.get("all", F.col("line")).alias("line_text")),
        "fetched",
    )
    # Of a line whose document is repeated as a whole, one copy is enough.
    texts = stored(fetched.groupBy("node").agg(F.first("sides").alias("sides"), F.first("line_text").alias("line_text")), "near_lines")
    discard(shared, fetched)
    variants = stored(_variants(texts), "variants")
    crowded = stored(
        variants.groupBy("variant").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a != b").select("variant"),
        "crowded",
    )
    rows = stored(
        variants.join(crowded, "variant").join(firsts, "node").select("variant", "place", F.struct("first", "node").alias("at")),
        "crowded_lines",
    )
    discard(variants, crowded)
    own = rows.where("place = -1").select("variant", F.col("at").alias("own"))
    longer = rows.where("place >= 0")
    replaced_first = stored(longer.groupBy("variant", "place").agg(F.min("at").alias("earliest")), "earliest")
    replaced = longer.join(replaced_first, ["variant", "place"]).select("at", "earliest")
    with_shorter = longer.join(own, "variant").select("at", F.col("own").alias("earliest"))
    longest = replaced_first.groupBy("variant").agg(F.min("earliest").alias("earliest"))
    with_longer = own.join(longest, "variant").select(F.col("own").alias("at"), "earliest")
    pairs = replaced.union(with_shorter).union(with_longer).where(F.col("earliest.first") < F.col("at.first"))
    near = _verified(
        pairs.select(F.col("at.node").alias("node"), F.col("earliest.node").alias("earlier")).distinct(),
        texts.select("node", "line_text"),
    )
    return near, [texts, rows, replaced_first]


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Per document with lines to remove: its key (``doc_id``, ``text_hash``), ``removed`` (their
    numbers, from 0, ascending) and ``near`` (how many of them no earlier line equals)."""
    lines = stored(read_lines(docs, doc_id, text, min_words), "lines")
    distinct = stored(
        lines.groupBy("node").agg(
            F.min(_order()).alias("first"), F.max(_order()).alias("last"), F.first("halves").alias("halves")
        ),
        "distinct_lines",
    )
    near, spent = _near(docs, distinct.where(F.size("halves") > 0).select("node", "first", "halves"), doc_id, text)
    near = near.withColumn("near", F.lit(True))
    touched = stored(
        distinct.select("node", "first", (F.col("first") != F.col("last")).alias("again"))
        .join(near, "node", "left")
        .where("again or near")
        .select("node", "first", F.coalesce("near", F.lit(False)).alias("near")),
        "touched",
    )
    discard(distinct, *spent)
    at = lines.select("doc_id", "text_hash", "line", "node", _order().alias("at"))
    gone = at.join(touched, "node").where(F.col("near") | (F.col("at") != F.col("first")))
    is_near = (F.col("near") & (F.col("at") == F.col("first"))).cast("int")
    return gone.groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set("line")).alias("removed"),
        F.size(F.collect_set(F.when(is_near == 1, F.col("line")))).alias("near"),
    )


def without_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: str | None = None,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """``docs``, columns as they are, without their repeated lines; documents that this leaves
    without a word go. ``size`` names a column that holds the text's length."""
    names = first_of(["doc_key", "body_hash", "removed_id", "removed_hash", "removed_lines", "left_text"], docs.columns)
    doc_key, body_hash, removed_id, removed_hash, removed_lines, left_text = names.values()
    removed = repeated_lines(docs, doc_id, text, min_words).select(
        F.col("doc_id").alias(removed_id), F.col("text_hash").alias(removed_hash), F.col("removed").alias(removed_lines)
    )
    read = docs.withColumns({doc_key: F.col(doc_id), body_hash: text_hash(text)})
    on = read[doc_key].eqNullSafe(removed[removed_id]) & (read[body_hash] == removed[removed_hash])

    def rest(lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(removed_lines))
        return F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n")

    # The lines are bound to a variable, so that the text is split once.
    body = F.get(F.transform(F.array(F.split(F.col(text), "\n")), rest), F.lit(0))
    changed = F.col(removed_lines).isNotNull()
    joined = read.join(removed, on, "left").withColumn(left_text, F.when(changed, body))
    left = joined.where(~changed | F.col(left_text).rlike(r"\S"))
    columns = []
    for name in docs.columns:
        column = F.col(name)
        if name == text:
            column = F.when(changed, F.col(left_text)).otherwise(column)
        elif name == size:
            length = F.length(left_text).cast(docs.schema[name].dataType)
            column = F.when(changed, length).otherwise(column)
        columns.append(column.alias(name))
    return left.select(*columns)
