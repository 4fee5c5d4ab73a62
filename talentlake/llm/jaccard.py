"""N-gram Jaccard join with Bayesian candidate pruning.

Texts with one set of word shingles are one class (copies; similarity 1). Classes that share a
band of MinHash values are candidates. Connected candidates form pools; a pool's texts are
brought together once, and there each candidate pair's MinHash values are compared a few at a
time: with m of h values equal and a flat prior, the similarity's posterior is a beta
distribution, and a pair whose probability of reaching the threshold is below ``tolerance`` is
dropped. What is left is verified exactly on the shingle sets.

A task returns, per class, the documents it links to and the least class of its local group,
never pairs: a group of near copies costs rows in proportion to its classes. A pool too large
for one task is dealt by hash into blocks of bounded words and every two blocks meet in a task.
Candidate bands move as hashes; texts move once, and only texts of pools are compared.

A pair at the threshold is missed by all bands with probability 1e-7 (see ``BANDS``), and
dropped by pruning with about ``tolerance`` per comparison step.

Null or empty text: no shingle, links with nothing. Texts of fewer words than a shingle: one
shingle. Repeated rows are copies of one class. Null ids come last when the least is taken. An
empty table gives an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentlake.llm.components import components, local_roots
from talentlake.llm.frames import first_of, give_back, map_slices, same, text_hash, texts_of, typed
from talentlake.llm.shingles import WORDS, mixed, shingles
from talentlake.workspace import stored

THRESHOLD = 0.8
BANDS = 40  # (1 - 0.8 ** 5) ** 40 = 1.2e-7
BAND_VALUES = 5
VALUES = BANDS * BAND_VALUES
STEP_VALUES = 20
TOLERANCE = 1e-7
BLOCK_CLASSES = 1024
BLOCK_WORDS = 400_000
SEED = 29
TILE = 64
FEW = 16

_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_FLIPS = _random.integers(0, 1 << 32, VALUES, dtype=np.uint64).astype(np.uint32)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of MinHash values for each set; none may be empty."""
    if not sets:
        return np.zeros((0, VALUES), dtype=np.uint32)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), VALUES), dtype=np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat((x ^ _FLIPS[k]) * _FACTORS[k], starts)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """A row of band hashes for each row of MinHash values."""
    grouped = values.reshape(len(values), BANDS, BAND_VALUES).astype(np.uint64)
    total = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
    for k in range(BAND_VALUES):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + grouped[:, :, k])
    return total.view(np.int64)


def least_equal(values: int, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> int:
    """Fewest equal values of ``values`` at which the posterior probability of reaching the
    threshold is not below the tolerance. With a flat prior that probability, for m equal
    values, is the chance of at most m successes in ``values + 1`` trials."""
    below = 0.0
    for m in range(values + 1):
        below += comb(values + 1, m) * threshold**m * (1 - threshold) ** (values + 1 - m)
        if below >= tolerance:
            return m
    return values


_LEAST = {h: least_equal(h) for h in range(STEP_VALUES, VALUES + 1, STEP_VALUES)}


def _overlaps(one: np.ndarray, joined: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """Shingles that a set shares with each of the sets whose sorted postings are given."""
    low, high = np.searchsorted(joined, one), np.searchsorted(joined, one, side="right")
    counts = high - low
    at = np.repeat(high - np.cumsum(counts), counts) + np.arange(counts.sum())
    return np.bincount(owner[at], minlength=size)


def similar_pairs(
    left: list[np.ndarray], right: list[np.ndarray] | None, threshold: float = THRESHOLD
) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the similar pairs of two lists of sets, or of one list with itself."""
    within = right is None
    right = left if within else right
    on_left = minhashes(left)
    on_right = on_left if within else minhashes(right)
    n_left, n_right = np.array([len(s) for s in left]), np.array([len(s) for s in right])
    postings = None
    found = []
    for start in range(0, len(left), TILE):
        rows = slice(start, start + TILE)
        # Sizes alone rule out what cannot reach the threshold.
        small, large = np.minimum(n_left[rows, None], n_right), np.maximum(n_left[rows, None], n_right)
        near = small >= threshold * large
        if within:
            near &= np.arange(len(right))[None, :] > np.arange(start, start + len(near))[:, None]
        a, b = np.nonzero(near)
        a += start
        equal = np.zeros(len(a), dtype=np.int32)
        for h in range(STEP_VALUES, VALUES + 1, STEP_VALUES):
            if not len(a):
                break
            step = slice(h - STEP_VALUES, h)
            equal = equal + (on_left[a, step] == on_right[b, step]).sum(axis=1)
            likely = equal >= _LEAST[h]
            a, b, equal = a[likely], b[likely], equal[likely]
        for i in np.unique(a).tolist():
            mine = b[a == i]
            if len(mine) <= FEW:
                shared = np.array([len(np.intersect1d(left[i], right[j], assume_unique=True)) for j in mine.tolist()])
            else:
                if postings is None:
                    owner = np.repeat(np.arange(len(right)), n_right)
                    joined = np.concatenate(right)
                    order = np.argsort(joined, kind="stable")
                    postings = joined[order], owner[order]
                shared = _overlaps(left[i], *postings, len(right))[mine]
            close = shared >= threshold * (n_left[i] + n_right[mine] - shared) - 1e-9
            found.append((np.full(close.sum(), i), mine[close]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def sketched(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """Per document its key, ``node`` (hash of its shingle set; null without shingles), the
    set's size and its bands."""

    def sketch(batch: pa.RecordBatch) -> dict[str, object]:
        sets = [shingles(t, words) for t in texts_of(batch)]
        full = [i for i, s in enumerate(sets) if len(s)]
        keys = bands(minhashes([sets[i] for i in full]))
        node, rows = [None] * len(sets), [None] * len(sets)
        for i, row in zip(full, keys):
            node[i], rows[i] = xxhash.xxh64_intdigest(sets[i].tobytes()) - 2**63, row
        return {
            "doc_id": batch.column("doc_id"),
            "text_hash": batch.column("text_hash"),
            "node": pa.array(node, type=pa.int64()),
            "n": pa.array([len(s) for s in sets], type=pa.int64()),
            "bands": pa.array(rows, type=pa.list_(pa.int64())),
        }

    read = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    schema = f"doc_id {typed(read, 'doc_id')}, text_hash bigint, node bigint, n bigint, bands array<bigint>"
    return map_slices(read, sketch, schema)


def jaccard_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    threshold: float = THRESHOLD,
    block_classes: int = BLOCK_CLASSES,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: its key (``doc_id``, ``text_hash``), ``class_id`` (least id with the
    same shingles), ``n_links`` (other documents linked directly), ``group_id`` (least id
    reachable by links) and ``kept`` (the document is its group's first)."""
    sketches = stored(sketched(docs, doc_id, text, words), "sketches")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    classes = stored(
        sketches.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(F.min(key).alias("first"), F.count("*").alias("size"), F.max("n").alias("n"), F.first("bands").alias("bands")),
        "classes",
    )
    entries = classes.select("node", F.explode("bands").alias("band"))
    crowded = stored(
        entries.groupBy("band")
        .agg(F.min("node").alias("least"), F.max("node").alias("most"))
        .where(F.col("least") != F.col("most"))
        .select("band", "least"),
        "bands",
    )
    candidates = entries.join(crowded, "band").select("node", "least").distinct()
    pools = stored(components(stored(candidates, "candidates")), "pools")
    members = pools.join(classes.select("node", "first", "size", "n"), "node")
    blocks = stored(
        members.groupBy("component").agg(
            F.greatest(
                F.ceil(F.count("*") / block_classes), F.ceil(F.sum("n") / block_words), F.lit(1)
            )
            .cast("int")
            .alias("blocks"),
            F.sum("n").alias("words"),
        ),
        "pool_blocks",
    )
    moved = blocks.agg(F.sum(F.col("words") * F.col("blocks"))).first()[0] or 0
    buckets = int(moved // block_words) + 1
    read = docs.select(F.col(doc_id).alias("doc_id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    placed = members.join(blocks, "component").select(
        "node", "component", "size", "blocks", F.col("first.doc_id").alias("doc_id"), F.col("first.text_hash").alias("text_hash")
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    with_text = read.join(placed, same(read, placed, "doc_id", "text_hash")).select(
        "node", "component", "size", "text", own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    pair = [F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    dealt = with_text.select("node", "component", "size", "text", "own", *pair).withColumn(
        "bucket", F.pmod(F.xxhash64("component", "low", "high"), F.lit(buckets))
    )

    def compare(group: pa.Table) -> pa.Table:
        columns = {name: group.column(name).to_pylist() for name in ("node", "component", "size", "own", "low", "high")}
        texts = group.column("text")
        tasks: dict[tuple, dict[int, int]] = {}
        for i, (c, low, high, node) in enumerate(zip(*(columns[x] for x in ("component", "low", "high", "node")))):
            tasks.setdefault((c, low, high), {})[node] = i  # a repeated row brings its class once
        out: dict[str, list] = {"node": [], "links": [], "root": []}
        for (_, low, high), rows in tasks.items():
            at = list(rows.values())
            node, size = np.array(list(rows)), np.array([columns["size"][i] for i in at])
            side = np.array([columns["own"][i] for i in at])
            sets = [shingles(texts[i].as_py() or "", words) for i in at]
            if low == high:
                a, b = similar_pairs(sets, None, threshold)
            else:
                first, second = np.flatnonzero(side == low), np.flatnonzero(side == high)
                a, b = similar_pairs([sets[i] for i in first], [sets[i] for i in second], threshold)
                a, b = first[a], second[b]
            links = np.bincount(a, size[b], len(node)) + np.bincount(b, size[a], len(node))
            root, linked = local_roots(len(node), a, b), links > 0
            out["node"] += node[linked].tolist()
            out["links"] += links[linked].astype(np.int64).tolist()
            out["root"] += node[root[linked]].tolist()
        del columns, texts, tasks
        give_back()
        return pa.table({name: pa.array(values, type=pa.int64()) for name, values in out.items()})

    compared = stored(dealt.groupBy("bucket").applyInArrow(compare, "node bigint, links bigint, root bigint"), "compared")
    direct = compared.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = stored(
        classes.select("node", "size", "first")
        .join(components(compared.select("node", "root")), "node", "left")
        .join(direct, "node", "left")
        .withColumn("component", F.coalesce("component", "node")),
        "grouped",
    )
    firsts = stored(grouped.groupBy("component").agg(F.min("first").alias("group_first")), "firsts")
    of_node = stored(
        grouped.join(firsts, "component").select(
            "node", "first", "group_first", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
        ),
        "of_node",
    )
    own_key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    return sketches.select("doc_id", "text_hash", "node").join(of_node, "node", "left").select(
        "doc_id",
        "text_hash",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("group_first.doc_id")).alias("group_id"),
        (F.col("node").isNull() | (own_key == F.col("group_first"))).alias("kept"),
    )


def first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: float) -> DataFrame:
    """``docs``, columns as they are, with one document of each group; texts without words all
    stay, rows repeated as a whole are one document."""
    names = first_of(["doc_key", "body_hash", "blank", "place"], docs.columns)
    doc_key, body_hash, blank, place = names.values()
    rows = jaccard_join(docs, doc_id, text, **options).where("kept")
    kept = rows.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash")).distinct()
    # Blank texts need no window, and all of them without an id would be one group of it.
    is_blank = ~F.coalesce(F.col(text), F.lit("")).rlike(r"\S")
    read = docs.withColumns({doc_key: F.col(doc_id), body_hash: text_hash(text), blank: is_blank})
    on = read[doc_key].eqNullSafe(kept["kept_id"]) & (read[body_hash] == kept["kept_hash"])
    copies = Window.partitionBy(doc_key, body_hash).orderBy(body_hash)
    first = read.where(~F.col(blank)).join(kept, on, "left_semi").withColumn(place, F.row_number().over(copies))
    return first.where(F.col(place) == 1).select(*docs.columns).union(read.where(blank).select(*docs.columns))
