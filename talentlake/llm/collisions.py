"""Embedding near-duplicates by collision-counting projections.

Vectors are projected on many random lines and sorted along each. A query's window on a line is
centred on it; a pair's collisions are the lines on which one lies in the other's window. For a
pair at the threshold a window holds the other with a known probability, so the count that all
but ``miss`` of such pairs reach follows from the binomial distribution. Pairs that reach it are
verified by their exact cosine in double precision.

Equal vectors of one label are one class, so a group of copies is one point however large. A
label's classes are dealt by hash into blocks of about ``block`` vectors, and each task takes
two blocks of one label: its memory is bounded, and a label with a third of all vectors is many
tasks. A task returns, per vector, the number of its links and the least vector of its local
component, never pairs; so what moves is linear in the vectors of each block pair. The work
inside blocks grows with the square of a label's distinct vectors, since windows on single lines
cannot part vectors of high dimension.

Vectors that are null, zero or hold null or non-finite components, and those without label, link
with nothing. Vectors of different lengths do not link. Repeated rows are copies. A null id is
passed by when the least id is taken; a component of null ids only has a null id and is kept.
An empty table gives an empty result.
"""

from __future__ import annotations

from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.components import components, local_roots
from talentlake.llm.frames import map_slices, typed
from talentlake.workspace import stored

THRESHOLD = 0.93
LINES = 24
WINDOW = 2.5  # half width, in standard deviations of a pair's difference at the threshold
MISS = 1e-9
BLOCK = 2048
SEED = 17
TILE = 256


def least_collisions(lines: int = LINES, window: float = WINDOW, miss: float = MISS) -> int:
    """Largest count that a pair at the threshold fails to reach with probability ``miss`` at most."""
    p = erf(window / sqrt(2))
    below = 0.0
    for count in range(lines + 1):
        below += comb(lines, count) * p**count * (1 - p) ** (lines - count)
        if below > miss:
            return count
    return lines


def collisions(left: np.ndarray, right: np.ndarray, width: float) -> np.ndarray:
    """Per pair of rows the lines (columns) on which they lie within ``width``."""
    counts = np.zeros((len(left), len(right)), dtype=np.int16)
    rows = np.arange(len(left))
    for line in range(left.shape[1]):
        order = np.argsort(right[:, line], kind="stable")
        at = right[order, line]
        steps = np.zeros((len(left), len(right) + 1), dtype=np.int16)
        steps[rows, np.searchsorted(at, left[:, line] - width)] += 1
        steps[rows, np.searchsorted(at, left[:, line] + width, side="right")] -= 1
        counts[:, order] += np.cumsum(steps, axis=1, dtype=np.int16)[:, :-1]
    return counts


def links(left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs of unit vectors."""
    dim = left.shape[1]
    lines = np.random.default_rng(SEED).standard_normal((dim, LINES))
    lines /= np.linalg.norm(lines, axis=0)
    width = WINDOW * sqrt(2 - 2 * threshold) / sqrt(dim)
    on_left, on_right, least = left @ lines, right @ lines, least_collisions()
    found = []
    for start in range(0, len(left), TILE):
        rows, cols = np.nonzero(collisions(on_left[start : start + TILE], on_right, width) >= least)
        for at in range(0, len(rows), 1 << 16):
            a, b = rows[at : at + (1 << 16)] + start, cols[at : at + (1 << 16)]
            close = np.einsum("ij,ij->i", left[a], right[b]) >= threshold
            found.append((a[close], b[close]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, in double precision, of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keyed(vectors: DataFrame) -> DataFrame:
    """Adds ``node``: a hash of label and vector; null where the vector links with nothing."""

    def keys(batch: pa.RecordBatch) -> dict[str, object]:
        nodes = []
        for vector, label in zip(batch.column("vector").to_pylist(), batch.column("label").to_pylist()):
            usable = label is not None and bool(vector) and all(v is not None for v in vector)
            x = np.array(vector, dtype=np.float64) if usable else np.zeros(0)
            usable = usable and bool(np.isfinite(x).all()) and 0 < np.linalg.norm(x) < np.inf
            nodes.append(xxhash.xxh64_intdigest(x.tobytes() + repr(label).encode()) - 2**63 if usable else None)
        return {name: batch.column(name) for name in ("vec_id", "label", "vector")} | {
            "node": pa.array(nodes, type=pa.int64())
        }

    schema = ", ".join(f"{name} {typed(vectors, name)}" for name in ("vec_id", "label", "vector"))
    return map_slices(vectors, keys, f"{schema}, node bigint")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    read = vectors.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    keyed = stored(_keyed(read), "vectors")
    classes = stored(
        keyed.where(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.first("label").alias("label"),
            F.size(F.first("vector")).alias("dim"),
            F.first("vector").alias("vector"),
            F.count("*").alias("size"),
            F.min("vec_id").alias("least"),
        ),
        "classes",
    )
    blocks = stored(
        classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")), "blocks"
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = classes.join(blocks, ["label", "dim"]).select(
        "node",
        "label",
        "dim",
        "vector",
        "size",
        own.alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    ).select("*", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def compare(group: pa.Table) -> pa.Table:
        unit, node, size = _matrix(group.column("vector")), group.column("node").to_numpy(), group.column("size").to_numpy()
        block_of, low, high = group.column("own").to_numpy(), group.column("low")[0].as_py(), group.column("high")[0].as_py()
        a, b = np.flatnonzero(block_of == low), np.flatnonzero(block_of == high)
        left, right = links(unit[a], unit[b], threshold)
        left, right = a[left], b[right]
        if low == high:
            left, right = left[left < right], right[left < right]
        total = np.bincount(left, size[right], len(node)) + np.bincount(right, size[left], len(node))
        root = local_roots(len(node), left, right)
        linked = total > 0
        return pa.table({"node": node[linked], "links": total[linked].astype(np.int64), "root": node[root[linked]]})

    compared = stored(
        dealt.groupBy("label", "dim", "low", "high").applyInArrow(compare, "node bigint, links bigint, root bigint"),
        "compared",
    )
    direct = compared.groupBy("node").agg(F.sum("links").alias("links"))
    grouped = classes.select("node", "size", "least").join(components(compared.select("node", "root")), "node", "left")
    # A class without link is its own component; components are named by a node's hash.
    named = stored(grouped.withColumn("component", F.coalesce("component", "node")), "named")
    least = stored(named.groupBy("component").agg(F.min("least").alias("component_id")), "least")
    of_node = named.join(least, "component").join(direct, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
    )
    return (
        keyed.select("vec_id", "node")
        .join(stored(of_node, "of_node"), "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
