"""Phrase collocation mining: Apriori candidates counted by broadcast double-array tries.

Texts are cut into pieces and words once and stored as blocks: the distinct words of a few
megabytes of text of one language, and one number per word of the text. All later passes read
these numbers.

* **Candidates.** A phrase can be frequent only if the phrases without its first and without its
  last word are. A pass per length adds up the phrases that pass this test, in each task and then
  by a shuffle of partial sums. Words are known by 32-bit hashes there, which keeps that shuffle
  small, and the test reads bitmaps of fixed size of what was frequent so far. A collision can
  only add to a sum or let a phrase through, so no frequent phrase is lost.
* **Counts.** Candidates go into double-array tries over fixed-width word codes, at most
  ``TRIE_CANDIDATES`` each, which bounds what is broadcast; more candidates take more tries and
  passes. In each block numpy moves the states of all text positions forward at once, one code
  digit after the other, and counts the accepting states; the tasks' counts are summed as vectors,
  in two steps, so that no task gets those of all tasks. These are exact: words are compared as
  text.
* **Scores.** Counts, scores and the containment rule are joins and aggregates of the candidates.

Null or empty text: no words. Null language: ``und``. Null ids and repeated rows count like any
other row. Texts of any length are read whole; a block holds at least one text. Ties are settled
as the ranking says, by phrase last. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talentlake.llm.shingles import mixed
from talentlake.workspace import stored

MIN_COUNT = 30
MAX_WORDS = 4
SCALE = 2_000_000
CONTAINED_PERCENT = 80
TOP = 2_000
BLOCK_BYTES = 4_000_000
BITMAP_BITS = 26  # of the positions in a bitmap: 8 MB
TRIE_CANDIDATES = 1_000_000
PENDING = 4_000_000  # pairs, or hits, that a task holds before it adds them up
CHUNK = 4_096  # counts in one row of a vector
TASKS_TOGETHER = 256  # whose vectors are summed in the first step

# What ends a piece; the byte that stands for it is never part of UTF-8.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 255 if b in PIECE_ENDS else b for b in range(256))

_SEED = 42  # of Spark's xxhash64
_HALF = (1 << 32) - 1
_FOLD = 29  # by which a hash is shifted onto itself to give its place in a bitmap
_ROW_BITS = 15  # positions in one row of a bitmap
NO_LANGUAGE = "und"


class _Codes(dict):
    """Numbers for words in the order in which they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self)
        return code


def coded(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of texts, and the texts as word numbers from 1; 0 ends a piece."""
    tokens = BREAK.join(texts).translate(_LOWER).replace(BREAK, b" \xff ").split()
    codes = _Codes({BREAK: 0})
    numbers = np.fromiter(map(codes.__getitem__, tokens), dtype=np.int32, count=len(tokens))
    return list(codes)[1:], numbers


def blocks(docs: DataFrame, text: str = "text", lang: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, words, codes, n): the distinct words of a block, joined by spaces, its texts as
    numbers of those words, and how many words they have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, texts in waiting.items():
                words, numbers = coded(texts)
                if words:
                    yield pa.RecordBatch.from_pydict(
                        {
                            "lang": [name],
                            "words": pa.array([b" ".join(words)], pa.binary()),
                            "codes": pa.array([numbers.astype("<i4").tobytes()], pa.binary()),
                            "n": [int(np.count_nonzero(numbers))],
                        }
                    )
            waiting.clear()

        for batch in batches:
            for name, body in zip(batch.column("lang"), batch.column("text")):
                raw = body.as_py()
                if raw:
                    waiting.setdefault(name.as_py(), []).append(raw)
                    size += len(raw)
                    if size >= block_bytes:
                        yield from flush()
                        size = 0
        yield from flush()

    read = docs.select(
        F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text).cast("binary").alias("text")
    )
    return read.mapInArrow(run, "lang string, words binary, codes binary, n bigint")


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    for batch in batches:
        for lang, words, codes in zip(batch.column("lang"), batch.column("words"), batch.column("codes")):
            yield lang.as_py(), words.as_py().split(b" "), np.frombuffer(codes.as_py(), dtype="<i4")


def word_counts(cut: DataFrame) -> DataFrame:
    """(lang, word, f) over all blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _each_block(batches):
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * len(words)),
                    "word": pa.array([w.decode() for w in words]),
                    "f": pa.array(np.bincount(codes, minlength=len(words) + 1)[1:], pa.int64()),
                }
            )

    return (
        cut.select("lang", "words", "codes")
        .mapInArrow(run, "lang string, word string, f bigint")
        .groupBy("lang", "word")
        .agg(F.sum("f").alias("f"))
    )


def _keys(lang: str, words: list[bytes]) -> np.ndarray:
    """Low half of Spark's xxhash64(lang, word) of every word, after a 0 for the end of a piece."""
    seed, digest = xxhash.xxh64_intdigest(lang, _SEED), xxhash.xxh64_intdigest
    return np.array([0, *(digest(word, seed) & _HALF for word in words)], dtype=np.uint64)


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Which places of ``BITMAP_BITS`` bits the hashes fall on; its size does not depend on their
    number."""
    value = F.col(column)
    position = value.bitwiseXOR(F.shiftrightunsigned(value, _FOLD)).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    rows = (
        hashes.select(position.alias("p"))
        .groupBy(F.shiftright("p", _ROW_BITS).alias("row"))
        .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (BITMAP_BITS - 3), dtype=np.uint8)
    for row, bits in zip(rows.column("row").to_pylist(), rows.column("bits").to_pylist()):
        start = row << (_ROW_BITS - 3)
        out[start : start + len(bits)] = np.frombuffer(bits, dtype=np.uint8)
    return out


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be one of the bitmap's."""
    position = (hashes ^ (hashes >> np.uint64(_FOLD))) & np.uint64((1 << BITMAP_BITS) - 1)
    return (bits[position >> np.uint64(3)] >> (position & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _longer(prefix: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Hash of a phrase of two words or more and the word after it."""
    return mixed(prefix * np.uint64(0x9E3779B97F4A7C15) + key)


def pair_sums(cut: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(prefix, last, hash, n): sums over the pairs of words that may be frequent."""
    shared = cut.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, waiting = [], 0

        def flush() -> pa.RecordBatch:
            pair, n = np.unique(np.concatenate(pending) if pending else np.zeros(0, np.uint64), return_counts=True)
            pending.clear()
            return pa.RecordBatch.from_pydict({"pair": pa.array(pair.view(np.int64)), "n": pa.array(n.astype(np.int64))})

        for lang, words, codes in _each_block(batches):
            keys = _keys(lang, words)
            fine = in_bitmap(shared.value, keys)
            fine[0] = False
            good = fine[codes]
            at = np.flatnonzero(good[:-1] & good[1:])
            pending.append((keys[codes[at]] << np.uint64(32)) | keys[codes[at + 1]])
            waiting += len(at)
            if waiting >= PENDING:
                yield flush()
                waiting = 0
        yield flush()

    sums = cut.select("lang", "words", "codes").mapInArrow(run, "pair bigint, n bigint")
    pair = F.col("pair")
    return (
        sums.groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .select(
            F.shiftrightunsigned(pair, 32).alias("prefix"),
            pair.bitwiseAND(F.lit(_HALF)).alias("last"),
            pair.alias("hash"),
            "n",
        )
    )


def phrase_sums(cut: DataFrame, size: int, bitmaps: list[np.ndarray]) -> DataFrame:
    """(prefix, last, n): sums over the phrases of ``size`` words, three or more, whose two shorter
    phrases are in the bitmaps of all shorter sizes; the phrase without its last word, and the
    last word, are known by their hashes."""
    shared = cut.sparkSession.sparkContext.broadcast(bitmaps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, codes in _each_block(batches):
            keys = _keys(lang, words)
            fine = in_bitmap(shared.value[0], keys)
            fine[0] = False
            good = fine[codes]
            at = np.flatnonzero(good[:-1] & good[1:])
            start = keys[codes[at]]
            for width in range(2, size):
                # ``at`` holds the phrases of ``width`` words whose shorter phrases are fine.
                after = keys[codes[at + width - 1]]
                start = (start << np.uint64(32)) | after if width == 2 else _longer(start, after)
                fits = in_bitmap(shared.value[width - 1], start)
                at, start = at[fits], start[fits]
                follows = np.zeros(len(codes) + 1, dtype=bool)
                follows[at] = True
                both = follows[at + 1]
                at, start = at[both], start[both]
            last = keys[codes[at + size - 1]]
            _, first, n = np.unique(_longer(start, last), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "prefix": pa.array(start[first].view(np.int64)),
                    "last": pa.array(last[first].view(np.int64)),
                    "n": pa.array(n.astype(np.int64)),
                }
            )

    return (
        cut.select("lang", "words", "codes")
        .mapInArrow(run, "prefix bigint, last bigint, n bigint")
        .groupBy("prefix", "last")
        .agg(F.sum("n").alias("n"))
    )


def _hashed(sums: DataFrame) -> DataFrame:
    """Add each phrase's own hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, last = (batch.column(name).to_numpy().view(np.uint64) for name in ("prefix", "last"))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_longer(prefix, last).view(np.int64))], names=["prefix", "last", "n", "hash"]
            )

    return sums.select("prefix", "last", "n").mapInArrow(run, "prefix bigint, last bigint, n bigint, hash bigint")


def candidates(cut: DataFrame, frequent: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> DataFrame:
    """(id, lang, size, phrase) of all phrases of 2 to ``max_words`` words that may be frequent."""
    key = F.xxhash64("lang", "word").bitwiseAND(F.lit(_HALF))
    by_key = frequent.select("lang", "word", key.alias("key"))
    bitmaps = [bitmap(by_key, "key")]
    shorter = by_key.select("lang", F.col("word").alias("phrase"), F.col("key").alias("hash"))
    words = by_key.select(F.col("key").alias("last"), "word", F.col("lang").alias("word_lang"))
    found = []
    for size in range(2, max_words + 1):
        sums = pair_sums(cut, bitmaps[0]) if size == 2 else phrase_sums(cut, size, bitmaps)
        kept = sums.where(F.col("n") >= min_count)
        sums = stored(kept if size == 2 else _hashed(kept), "phrase_sums")
        spelled = stored(
            sums.join(shorter.withColumnRenamed("hash", "prefix"), "prefix")
            .join(words, "last")
            .where(F.col("lang") == F.col("word_lang"))
            .select("lang", F.concat_ws(" ", "phrase", "word").alias("phrase"), "hash"),
            "spelled",
        )
        found.append(spelled.select("lang", F.lit(size).alias("size"), "phrase"))
        bitmaps.append(bitmap(spelled, "hash"))
        shorter = spelled
    all_sizes = found[0]
    for more in found[1:]:
        all_sizes = all_sizes.union(more)
    return stored(all_sizes.distinct().withColumn("id", F.monotonically_increasing_id()), "candidates")


class Trie:
    """A double array over phrases whose words are numbers of ``width`` base-256 digits.

    A state is a slot. The child of state s by digit d is slot ``base[s] + d``, if that slot's
    ``check`` is s. ``accept`` gives the number of the phrase that ends in a state, or -1.
    """

    def __init__(self, phrases: list[tuple[int, ...]], n_words: int, seed: int = 7):
        self.width = 1 if n_words <= 1 << 8 else 2 if n_words <= 1 << 16 else 3
        if n_words > 1 << 24:
            raise ValueError("too many words for one trie")
        longest = max(map(len, phrases), default=0)
        sizes = np.fromiter(map(len, phrases), dtype=np.int64, count=len(phrases))
        words = np.zeros((len(phrases), longest), dtype=np.int64)
        words[np.arange(longest)[None, :] < sizes[:, None]] = [w for phrase in phrases for w in phrase]
        digits = np.stack([(words >> (8 * (self.width - 1 - k))) & 255 for k in range(self.width)], axis=2)
        digits = digits.reshape(len(phrases), longest * self.width)
        digits[np.arange(digits.shape[1])[None, :] >= (sizes * self.width)[:, None]] = -1
        order = np.lexsort(digits.T[::-1]) if len(phrases) else np.zeros(0, dtype=np.int64)
        self._place(digits[order], order, sizes[order] * self.width, seed)

    def _place(self, digits: np.ndarray, numbers: np.ndarray, depths: np.ndarray, seed: int) -> None:
        """Give every node a slot; nodes with most children first, those with one child last."""
        n = len(digits)
        of_row = np.zeros(n, dtype=np.int64)  # node of each row at the depth so far; 0 is the root
        parents, symbols, ends, nodes = [], [], np.full(n, -1, dtype=np.int64), 1
        for depth in range(digits.shape[1] if n else 0):
            live = np.flatnonzero(depths > depth)
            if not len(live):
                break
            d, parent = digits[live, depth], of_row[live]
            new = np.concatenate([[True], (d[1:] != d[:-1]) | (parent[1:] != parent[:-1])])
            parents.append(parent[new])
            symbols.append(d[new])
            of_row[live] = nodes + np.cumsum(new) - 1
            nodes += int(new.sum())
            done = live[depths[live] == depth + 1]
            ends[done] = of_row[done]
        parent = np.concatenate(parents) if parents else np.zeros(0, dtype=np.int64)
        symbol = np.concatenate(symbols) if symbols else np.zeros(0, dtype=np.int64)
        order = np.argsort(parent, kind="stable")
        owner, first, children = np.unique(parent[order], return_index=True, return_counts=True)
        size = 1024 + 3 * nodes
        end = size + 256  # beyond it, slots are added for what fits nowhere else
        taken = np.zeros(end, dtype=bool)
        taken[:256] = True  # so that a base is never below 0; slot 0 is the root
        slot_of = np.zeros(nodes, dtype=np.int64)
        base_of = np.zeros(nodes, dtype=np.int64)
        random = np.random.default_rng(seed)
        by_size = np.argsort(-children, kind="stable")
        several = by_size[children[by_size] > 1]
        for k in several.tolist():
            own = order[first[k] : first[k] + children[k]]
            wanted = symbol[own]
            for _ in range(16):
                bases = random.integers(1, size, 32)
                free = ~taken[bases[:, None] + wanted[None, :]].any(axis=1)
                if free.any():
                    base = int(bases[free.argmax()])
                    break
            else:
                base, end = end, end + 256
                if end > len(taken):
                    taken = np.concatenate([taken, np.zeros(max(1024, len(taken) // 8), dtype=bool)])
            taken[base + wanted] = True
            slot_of[1 + own] = base + wanted
            base_of[owner[k]] = base
        single = by_size[children[by_size] == 1]
        own = order[first[single]]
        free = np.flatnonzero(~taken)[: len(own)]
        if len(free) < len(own):
            more = len(own) - len(free)
            free = np.concatenate([free, np.arange(len(taken), len(taken) + more)])
            taken = np.concatenate([taken, np.zeros(more, dtype=bool)])
        slot_of[1 + own] = free
        base_of[owner[single]] = free - symbol[own]
        length = len(taken) + 256
        self.base = np.zeros(length, dtype=np.int32)
        self.check = np.full(length, -1, dtype=np.int32)
        self.accept = np.full(length, -1, dtype=np.int32)
        self.base[slot_of] = base_of
        self.check[slot_of[1:]] = slot_of[parent]
        self.accept[slot_of[ends]] = numbers

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the states have a child by the word, and those children."""
        kept = np.arange(len(states))
        for k in range(self.width):
            target = self.base[states] + ((words >> (8 * (self.width - 1 - k))) & 255)
            fits = self.check[target] == states
            kept, states, words = kept[fits], target[fits], words[fits]
        return kept, states

    def hits(self, words: np.ndarray, max_words: int) -> Iterator[np.ndarray]:
        """Numbers of the phrases found at all positions of a text (-1: no word of any phrase)."""
        at = np.flatnonzero(words >= 0)
        kept, states = self.step(np.zeros(len(at), dtype=np.int32), words[at])
        at = at[kept]
        for size in range(2, max_words + 1):
            inside = at + size - 1 < len(words)
            at, states = at[inside], states[inside]
            following = words[at + size - 1]
            known = following >= 0
            at, states, following = at[known], states[known], following[known]
            kept, states = self.step(states, following)
            at = at[kept]
            number = self.accept[states]
            yield number[number >= 0]


def trie_counts(cut: DataFrame, phrases: DataFrame, max_words: int, per_trie: int = TRIE_CANDIDATES) -> DataFrame:
    """(id, a): exact occurrences of the phrases (id, lang, phrase)."""
    session = cut.sparkSession
    shards = -(-phrases.count() // per_trie) or 1
    read, counted = cut.select("lang", "words", "codes"), []
    for shard in range(shards):
        rows = phrases.where(F.pmod(F.xxhash64("id"), F.lit(shards)) == shard).select("id", "lang", "phrase").toArrow()
        vocabulary: dict[str, dict[bytes, int]] = {}
        coded_phrases, n_words = [], 0
        for lang, phrase in zip(rows.column("lang").to_pylist(), rows.column("phrase").to_pylist()):
            known, phrase_words = vocabulary.setdefault(lang, {}), []
            for word in phrase.encode().split(b" "):
                if word not in known:
                    known[word] = n_words
                    n_words += 1
                phrase_words.append(known[word])
            coded_phrases.append(tuple(phrase_words))
        trie = Trie(coded_phrases, n_words)
        shared = session.sparkContext.broadcast((trie, vocabulary, rows.column("id").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            trie, vocabulary, ids = shared.value
            total, pending, waiting = np.zeros(len(ids), dtype=np.int64), [], 0
            for lang, words, codes in _each_block(batches):
                known = vocabulary.get(lang)
                if not known:
                    continue
                number = np.array([-1, *(known.get(word, -1) for word in words)], dtype=np.int32)
                for hits in trie.hits(number[codes], max_words):
                    pending.append(hits)
                    waiting += len(hits)
                if waiting >= PENDING:
                    total += np.bincount(np.concatenate(pending), minlength=len(total))
                    pending, waiting = [], 0
            if pending:
                total += np.bincount(np.concatenate(pending), minlength=len(total))
            starts = range(0, len(total), CHUNK) if total.any() else ()
            yield pa.RecordBatch.from_pydict(
                {
                    "together": pa.array([TaskContext.get().partitionId() // TASKS_TOGETHER] * len(starts), pa.int32()),
                    "chunk": pa.array(list(starts), pa.int32()),
                    "counts": pa.array([total[i : i + CHUNK].tobytes() for i in starts], pa.binary()),
                }
            )

        def spelled_out(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids = shared.value[2]
            for batch in batches:
                for start, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                    a = np.frombuffer(counts, dtype=np.int64)
                    yield pa.RecordBatch.from_pydict({"id": pa.array(ids[start : start + len(a)]), "a": pa.array(a)})

        vectors = read.mapInArrow(run, "together int, chunk int, counts binary")
        near = vectors.groupBy("together", "chunk").applyInArrow(_added, "chunk int, counts binary")
        sums = near.groupBy("chunk").applyInArrow(_added, "chunk int, counts binary")
        counted.append(stored(sums.mapInArrow(spelled_out, "id bigint, a bigint").where("a > 0"), "trie_counts"))
        shared.destroy()
    out = counted[0]
    for more in counted[1:]:
        out = out.union(more)
    return out


def _added(group: pa.Table) -> pa.Table:
    """Vectors of one chunk as their sum."""
    rows = group.column("counts").to_pylist()
    total = np.zeros(len(rows[0]) // 8, dtype=np.int64)
    for counts in rows:
        total += np.frombuffer(counts, dtype=np.int64)
    return pa.table({"chunk": group.column("chunk").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _score(a: Column, parts: Column) -> Column:
    """floor(SCALE * a / parts), in decimals: the product may pass 64 bits."""
    product = a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(9,0)")
    remainder = product % parts.cast("decimal(20,0)")
    return ((product - remainder) / parts.cast("decimal(20,0)")).cast("bigint")


def _weakest_cuts(phrases: DataFrame, parts: DataFrame) -> DataFrame:
    """Per phrase (lang, phrase, size, a) its lowest-scoring cut: ``score``, ``l`` and ``r``."""
    cuts = phrases.select(
        "lang", "phrase", "size", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    ).withColumns(
        {
            "left": F.expr("substring_index(phrase, ' ', k)"),
            "right": F.expr("substring_index(phrase, ' ', k - size)"),
        }
    )
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    cut = F.struct(_score(F.col("a"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r")
    return (
        scored.groupBy("lang", "phrase", "size", "a")
        .agg(F.min(cut).alias("cut"))
        .select("lang", "phrase", "size", "a", "cut.score", "cut.l", "cut.r")
    )


def _contained(phrases: DataFrame, max_words: int) -> DataFrame:
    """(lang, phrase, longer_a): the highest count of a longer phrase around a phrase."""
    words = F.split("phrase", " ")
    inner = [
        F.when((F.col("size") > size) & (F.col("size") >= start + size - 1), F.array_join(F.slice(words, start, size), " "))
        for size in range(2, max_words)
        for start in range(1, max_words - size + 2)
    ]
    return (
        phrases.where("size > 2")
        .select("lang", "a", F.explode(F.array(*inner)).alias("phrase"))
        .where("phrase is not null")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer_a"))
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
    per_trie: int = TRIE_CANDIDATES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` is how often a phrase occurs, ``l`` and ``r`` are the counts of its two parts at the
    weakest cut, ``n`` is the language's words, and the score compares a with l + r."""
    cut = stored(blocks(docs, text, lang, block_bytes), "blocks", compression="zstd")
    totals = cut.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = stored(word_counts(cut).where(F.col("f") >= min_count), "frequent_words")
    found = candidates(cut, frequent, min_count, max_words)
    phrases = stored(
        found.join(trie_counts(cut, found, max_words, per_trie), "id").where(F.col("a") >= min_count).drop("id"),
        "phrases",
    )
    parts = frequent.select("lang", F.col("word").alias("phrase"), "f").union(
        phrases.where(F.col("size") < max_words).select("lang", "phrase", F.col("a").alias("f"))
    )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        _weakest_cuts(phrases, parts)
        .join(_contained(phrases, max_words), ["lang", "phrase"], "left")
        .where(F.col("longer_a").isNull() | (F.col("longer_a") * 100 < F.col("a") * contained_percent))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
