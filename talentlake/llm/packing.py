"""Packing by concatenate and cut.

Pass one tokenises every text once and stores its ids with the tokens that its task had before
it; the tasks' totals, one number each, give every task its global offset (a prefix sum).
Pass two cuts the one long concatenation into fixed windows: a document's ids are cut at the
window borders it crosses, and each piece is a boundary record of where it lies. No text and
no id is shuffled, and only the last sequence has padding.

Null or empty text: the separator alone. Null ids and repeated rows: packed like any other
row. Very long texts span many sequences. An empty table gives no piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talentlake.llm.frames import give_back, remembered, slices, texts_of, typed
from talentlake.workspace import stored

LENGTH = 2048
SEPARATOR = 1
# Tasks whose totals, 16 bytes each, may be broadcast; beyond it they are joined by a shuffle.
BROADCAST_TASKS = 4_000_000
# Words, and what stands between white space, whose ids a worker remembers.
REMEMBERED_WORDS = 400_000
REMEMBERED_CHUNKS = 400_000

# Texts of these characters only are lower-cased and split here as the tokenizer's own
# normaliser and pattern do it; all others go through the tokenizer whole.
_PLAIN = re.compile("[\t\n\r -~\xa1-\xac\xae-įı-ſ]*")
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
# Fixed value: the split pattern of word_bpe_49k.json, its classes written out.
_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+"
)
_ADDED = ("<|startoftext|>", "<|endoftext|>")  # fixed values: added tokens of that file
_WORD_END = "</w>"  # fixed value: mark of a word's last token


class WordTokenizer:
    """Ids of a text as little-endian unsigned 32-bit numbers; words are encoded once, and what
    stands between white space is put together once.

    For vocabularies with a word-end mark and the split pattern above: there, the ids of a
    text are those of its words one after the other. Unknown words of a text are encoded in
    one call and told apart by the mark.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def _learn_words(self, found: set[str]) -> None:
        if len(self.words) > REMEMBERED_WORDS:
            self.words.clear()
        new = [word for word in found if word not in self.words]
        if not new:
            return
        joined = self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)
        ids = np.array(joined[0].ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(new):
            raise ValueError("the vocabulary does not end every word with its mark")
        raw, start = ids.tobytes(), 0
        for word, end in zip(new, (cuts * 4).tolist()):
            self.words[word] = raw[start:end]
            start = end

    def _learn(self, chunks: set[str]) -> None:
        if len(self.known) > REMEMBERED_CHUNKS:
            self.known.clear()
        split = list(map(_SPLIT.findall, chunks))
        self._learn_words({word for own in split for word in own})
        words = self.words
        for chunk, own in zip(chunks, split):
            self.known[chunk] = words[own[0]] if len(own) == 1 else b"".join([words[word] for word in own])

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of every text. What is new in any of them is learnt in one go, and what is known
        is looked up once."""
        chunks, ends, whole = [], [], {}
        for i, text in enumerate(texts):
            if not _PLAIN.fullmatch(text) or any(token in text for token in _ADDED):
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                whole[i] = np.array(ids, dtype="<u4").tobytes()
            else:
                # No word goes beyond white space, so the ids between two spaces stand for themselves.
                chunks += text.lower().split()
            ends.append(len(chunks))
        found = list(map(self.known.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        if new:
            self._learn({chunks[i] for i in new})
            for i in new:
                found[i] = self.known[chunks[i]]
        out, start = [], 0
        for i, end in enumerate(ends):
            out.append(whole[i] if i in whole else b"".join(found[start:end]))
            start = end
        return out


def tokenised(docs: DataFrame, path: str, separator: int, doc_id: str, text: str) -> DataFrame:
    """Per document its ids, and where they lie among the ids of its task."""
    tail = np.array([separator], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, total = remembered(WordTokenizer, path).encode_all, 0
        part = TaskContext.get().partitionId()
        for batch in slices(batches):
            ids = [x + tail for x in encode_all(texts_of(batch))]
            sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            ends = total + np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(ids), part, dtype=np.int64)),
                    pa.array(ends - sizes),
                    pa.array(sizes),
                    pa.array(ids, type=pa.binary()),
                ],
                names=["doc_id", "part", "before", "doc_tokens", "ids"],
            )
        give_back()

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {typed(read, 'doc_id')}, part bigint, before bigint, doc_tokens bigint, ids binary"
    return read.mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = LENGTH,
    separator: int = SEPARATOR,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: the document and where in it (``start``, ``length``), the sequence and
    where in it (``sequence_id``, ``offset``), and the piece's ids (``ids``, binary)."""
    tokens = stored(tokenised(docs, tokenizer_path, separator, doc_id, text), "tokens", compression="zstd")
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("doc_tokens")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base")), "bases"
    )
    if bases.count() <= BROADCAST_TASKS:
        bases = F.broadcast(bases)
    first = F.col("base") + F.col("before")
    pieces = tokens.join(bases, "part").select(
        "doc_id",
        "doc_tokens",
        "ids",
        first.alias("first"),
        F.explode(
            F.sequence(F.floor(first / length), F.floor((first + F.col("doc_tokens") - 1) / length))
        ).alias("sequence_id"),
    )
    border = F.col("sequence_id") * length
    start = F.greatest(border, F.col("first"))
    end = F.least(border + length, F.col("first") + F.col("doc_tokens"))
    placed = pieces.select(
        "doc_id",
        (start - F.col("first")).alias("start"),
        (end - start).alias("length"),
        "doc_tokens",
        "sequence_id",
        (start - border).alias("offset"),
        "ids",
    )
    cut = F.substring(
        "ids", (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")
    )
    return placed.withColumn("ids", cut)
