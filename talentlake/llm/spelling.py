"""Spelling variant grouping: blocked Gram matrices of letter counts, then exact edits.

Words one edit apart have letter counts at a squared distance of at most two (one for an
inserted or deleted letter, two for a replaced one). Squared distances of whole blocks of words
are three matrix terms, x.x + y.y - 2 x.y, so numpy finds the few pairs within two by one product
per pair of blocks, and only these are compared letter by letter.

Blocks are words of one length, split further by a signature: how many letters a word has of
each of ``GROUPS`` classes. An edit moves a signature to itself or to one of few neighbours, of
the same length or of the next, so only neighbouring blocks meet. Which blocks exist is a small
table, joined to itself by signature; a block too large for one product is dealt into slices of
bounded words and letters, and every two slices of neighbouring blocks meet once. A task returns
one row per word and product, never pairs.

Null or empty text: no words. A null id counts as an empty text before the colon. Repeated rows
count again. Texts and words of any length are read whole. Ties: the smallest word by code points.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import slices
from talentlake.workspace import stored

MIN_LETTERS = 6
MIN_COUNT = 5
RATIO = 5  # how much more frequent a form is than its variant
TYPO_MODULUS = 199  # a run whose hash it divides loses a letter
GROUPS = 8
SLICE_WORDS = 2_000
SLICE_LETTERS = 2_000_000
BUCKET_ROWS = 20_000
PENDING_WORDS = 300_000
# Steps of pointer doubling: a form is RATIO times as frequent as its variant, so a chain that
# long would need counts beyond 64 bits.
ROUNDS = 6

# The letters of a run, as bytes of Latin-1; only A-Z are lower-cased.
_LETTERS = bytes([*range(97, 123), *range(0xC0, 0x100)])
_RUNS = bytes(b + 32 if 65 <= b <= 90 else b if b in _LETTERS else 32 for b in range(256))
_COLUMN = np.zeros(256, dtype=np.int64)
_COLUMN[list(_LETTERS)] = np.arange(len(_LETTERS))


class _Utf8(dict):
    """UTF-8 of Latin-1 runs, remembered up to a bound."""

    def __missing__(self, run: bytes) -> bytes:
        if len(self) > PENDING_WORDS:
            self.clear()
        self[run] = out = run.decode("latin-1").encode()
        return out


_utf8 = _Utf8()


def runs(doc_id: str, text: str) -> list[bytes]:
    """A text's lower-cased letter runs in Latin-1, some of them a letter short by the rule of
    the hash of id and run."""
    found = text.encode("latin-1", "replace").translate(_RUNS).split()
    if not found:
        return found
    start, crc = zlib.crc32(f"{doc_id}:".encode()), zlib.crc32
    if text.isascii():
        hashes = [crc(run, start) for run in found]
    else:
        hashes = [crc(_utf8[run], start) for run in found]
    for i in np.flatnonzero(np.array(hashes, dtype=np.int64) % TYPO_MODULUS == 0).tolist():
        k = hashes[i] % len(found[i])
        found[i] = found[i][:k] + found[i][k + 1 :]
    return found


def words(docs: DataFrame, doc_id: str, text: str, min_letters: int, min_count: int) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            kept = [(word, n) for word, n in seen.items() if len(word) >= min_letters]
            seen.clear()
            return pa.RecordBatch.from_pydict(
                {
                    "word": pa.array([word.decode("latin-1") for word, _ in kept], pa.string()),
                    "n": pa.array([n for _, n in kept], pa.int64()),
                }
            )

        for batch in slices(batches, 64):
            for key, body in zip(batch.column("doc_id"), batch.column("text")):
                seen.update(runs(key.as_py(), body.as_py()))
            if len(seen) > PENDING_WORDS:
                yield rows()
        yield rows()

    read = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text")
    )
    return (
        read.mapInArrow(count, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= min_count)
    )


def with_signature(counted: DataFrame) -> DataFrame:
    """Add ``counts``, letters by class (code point modulo ``GROUPS``), and ``block``, their text."""
    classes = ["".join(chr(b) for b in _LETTERS if b % GROUPS == g) for g in range(GROUPS)]
    counts = [F.length("word") - F.length(F.translate("word", letters, "")) for letters in classes]
    return counted.withColumn("counts", F.array(*counts)).withColumn("block", F.concat_ws(",", F.col("counts").cast("array<string>")))


def meetings(found: DataFrame, slice_words: int, slice_letters: int) -> DataFrame:
    """(block, slice, job, role): which slices of which blocks meet in which product. Role 0: home
    words, compared with each other too; 1: home words; 2: visitors. Two blocks of a slice each
    meet in the job of the home block, all others in a job of their own."""
    length = F.aggregate("counts", F.lit(0), lambda total, c: total + c)
    parts = F.greatest(F.ceil(F.col("n_words") / slice_words), F.ceil(F.col("n_words") * length / slice_letters))
    known = stored(
        found.groupBy("block", "counts").agg(F.count("*").alias("n_words")).select("block", "counts", parts.cast("long").alias("slices")),
        "blocks",
    )
    # One letter more, or one letter of a class for one of a later class: every two neighbours once.
    moves = [(-1, to) for to in range(GROUPS)] + [(out, to) for out in range(GROUPS) for to in range(out + 1, GROUPS)]
    steps = F.array(*[F.array(*[F.lit((x == to) - (x == out)) for x in range(GROUPS)]) for out, to in moves])
    moved = F.zip_with("counts", "step", lambda c, s: c + s)
    near = known.withColumn("step", F.explode(steps)).select(
        F.col("block").alias("home"),
        F.col("slices").alias("home_slices"),
        F.concat_ws(",", moved.cast("array<string>")).alias("block"),
    )
    pairs = stored(near.join(known.select("block", "slices"), "block"), "neighbours")
    one = (F.col("slices") == 1) & (F.col("home_slices") == 1)
    zero = F.lit(0).cast("long")

    def role(job: str, block: str, part: str, number: int) -> DataFrame:
        return F.struct(F.col(block).alias("block"), F.col(part).alias("slice"), F.col(job).alias("job"), F.lit(number).alias("role"))

    def numbers(most: str) -> DataFrame:
        return F.explode(F.sequence(zero, F.col(most) - 1))

    alone = known.where("slices = 1").select("block", zero.alias("slice"), F.col("block").alias("job"), F.lit(0).alias("role"))
    visits = pairs.where(one).select("block", zero.alias("slice"), F.col("home").alias("job"), F.lit(2).alias("role"))
    crowded = (
        pairs.where(~one)
        .withColumn("i", numbers("home_slices"))
        .withColumn("j", numbers("slices"))
        .withColumn("job", F.concat_ws(":", "home", "i", "block", "j"))
        .select(F.explode(F.array(role("job", "home", "i", 1), role("job", "block", "j", 2))).alias("r"))
        .select("r.*")
    )
    within = (
        known.where("slices > 1")
        .withColumn("i", numbers("slices"))
        .withColumn("j", numbers("slices"))
        .where("i <= j")
        .withColumn("job", F.concat_ws(":", "block", "i", "block", "j"))
    )
    diagonal = within.where("i = j").select("block", F.col("i").alias("slice"), "job", F.lit(0).alias("role"))
    across = (
        within.where("i < j")
        .select(F.explode(F.array(role("job", "block", "i", 1), role("job", "block", "j", 2))).alias("r"))
        .select("r.*")
    )
    roles = alone.union(visits).union(crowded).union(diagonal).union(across)
    return roles.join(known.select("block", F.col("slices").alias("of")), "block")


def _letter_counts(letters: np.ndarray) -> np.ndarray:
    rows = np.arange(len(letters))[:, None] * len(_LETTERS)
    cells = np.bincount((rows + _COLUMN[letters]).ravel(), minlength=len(letters) * len(_LETTERS))
    return cells.reshape(len(letters), len(_LETTERS)).astype(np.float32)


def close_pairs(left: np.ndarray, right: np.ndarray, within: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two letter matrices that are one edit apart; ``right`` has as many columns as
    ``left``, or one more. ``within``: ``right`` is ``left``, and each pair is given once."""
    x, y = _letter_counts(left), _letter_counts(right)
    distance = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    a, b = np.nonzero(distance <= 2.5)
    if within:
        a, b = a[a < b], b[a < b]
    width = left.shape[1]
    one, other = left[a], right[b]
    if right.shape[1] == width:
        good = (one != other).sum(axis=1) == 1
    else:
        # Equal before the extra letter and after it.
        ahead = np.minimum.accumulate(one == other[:, :width], axis=1).sum(axis=1)
        behind = np.minimum.accumulate((one == other[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        good = ahead + behind >= width
    return a[good], b[good]


def _matrix(some: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(some), dtype=np.uint8).reshape(len(some), -1)


def _job(texts: list[bytes], n: np.ndarray, roles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one job's words: those with a near word, how many, and which one is the most frequent."""
    home = np.flatnonzero(roles < 2)
    matrix = _matrix([texts[i] for i in home])
    width = matrix.shape[1]
    found = []
    if roles[home[0]] == 0:
        a, b = close_pairs(matrix, matrix, within=True)
        found.append((home[a], home[b]))
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    for size in (width, width + 1):
        visitors = np.flatnonzero((roles == 2) & (lengths == size))
        if len(visitors):
            a, b = close_pairs(matrix, _matrix([texts[i] for i in visitors]))
            found.append((home[a], visitors[b]))
    a = np.concatenate([x for x, _ in found] + [y for _, y in found]) if found else np.zeros(0, dtype=np.int64)
    b = np.concatenate([y for _, y in found] + [x for x, _ in found]) if found else np.zeros(0, dtype=np.int64)
    if not len(a):
        return a, a, a
    # Latin-1 bytes sort as code points do.
    names = {i: texts[i] for i in set(b.tolist())}
    rank = np.zeros(len(texts), dtype=np.int64)
    rank[sorted(names, key=names.__getitem__)] = np.arange(len(names))
    order = np.lexsort((rank[b], -n[b], a))
    word, first, near = np.unique(a[order], return_index=True, return_counts=True)
    return word, near, b[order][first]


def near_words(found: DataFrame, slice_words: int = SLICE_WORDS, slice_letters: int = SLICE_LETTERS) -> DataFrame:
    """(word, n_near, best): of every word with near words their number and the most frequent one,
    as a struct of its negated count and itself."""
    roles = stored(meetings(found, slice_words, slice_letters), "roles")
    part = F.pmod(F.xxhash64("word"), F.col("of"))
    buckets = int(found.count() * 20 // BUCKET_ROWS) + 1
    one, many = roles.where("of = 1"), roles.where("of > 1")
    rows = found.join(one.select("block", "job", "role"), "block").select("word", "n", "job", "role")
    dealt = found.join(many, "block").where(part == F.col("slice")).select("word", "n", "job", "role")
    bucket = F.pmod(F.xxhash64("job"), F.lit(buckets)).alias("bucket")

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by("job")
        jobs = group.column("job").to_numpy()
        texts = [word.encode("latin-1") for word in group.column("word").to_pylist()]
        n, roles_ = group.column("n").to_numpy(), group.column("role").to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(jobs[1:] != jobs[:-1]) + 1, [len(jobs)]])
        word, near, best = [], [], []
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if end - start > 1 and (roles_[start:end] < 2).any():
                w, count, b = _job(texts[start:end], n[start:end], roles_[start:end])
                word.append(w + start)
                near.append(count)
                best.append(b + start)
        at = np.concatenate(word) if word else np.zeros(0, dtype=np.int64)
        to = np.concatenate(best) if best else np.zeros(0, dtype=np.int64)
        names = group.column("word").combine_chunks()
        return pa.table(
            {
                "word": names.take(pa.array(at)),
                "n_near": pa.array(np.concatenate(near) if near else [], pa.int64()),
                "best_n": pa.array(n[to], pa.int64()),
                "best": names.take(pa.array(to)),
            }
        )

    compared = (
        rows.union(dealt)
        .select("word", "n", "job", "role", bucket)
        .groupBy("bucket")
        .applyInArrow(compare, "word string, n_near bigint, best_n bigint, best string")
    )
    best = F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("form"))
    return stored(compared, "compared").groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form), where forms may have forms, by doubling the steps taken."""
    current = stored(links.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            current.join(onward, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        current = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return current


def variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    ratio: int = RATIO,
    slice_words: int = SLICE_WORDS,
    slice_letters: int = SLICE_LETTERS,
) -> DataFrame:
    """One row per word: ``word``, its ``form`` (the most frequent near word, if that is ``ratio``
    times as frequent), the ``root`` that forms lead to, ``n``, ``n_near`` and ``form_n``."""
    found = stored(with_signature(words(docs, doc_id, text, min_letters, min_count)), "words")
    near = near_words(found, slice_words, slice_letters)
    best_n = -F.col("best.minus_n")
    is_form = best_n >= F.col("n") * ratio
    judged = stored(
        found.select("word", "n")
        .join(near, "word", "left")
        .select(
            "word",
            F.when(is_form, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, best_n).alias("form_n"),
        ),
        "judged",
    )
    leads = roots(judged.where("form is not null"))
    return judged.join(leads, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
