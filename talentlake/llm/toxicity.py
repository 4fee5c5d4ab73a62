"""Toxicity by class-conditional Kneser-Ney models over words.

Two models, one of toxic and one of ordinary labelled texts, give each word a probability. A
class knows a word by its continuation count, the distinct words that it follows there, less a
discount; what the discounts free goes to counts that both models share, gathered from all texts
of the corpus. So a word that neither class has seen more often than the discount costs both the
same, and how often it is written anywhere says how much to make of a class that uses it. Both
models also give ``SHARED_WEIGHT`` to the shared counts outright: of a hundred texts a class
learns few words well, and the rest would be noise. A text's score is a logistic function, fitted
on labelled texts outside the counts, of the difference of its two log-likelihoods per word. Of
the larger class only as many texts are counted as the smaller one has, chosen by a hash: with
equal amounts, words too rare to tell are as often missing from one class as from the other.

Labelled ids are a sample of at most ``max_labelled`` rows, broadcast to the passes that need it.
The model is a number for each word that a class has more often than the discount, which that
sample bounds; shared counts of these words leave a task as at most one row per word.

Null or empty text, or none but white space: a difference of 0, so the score of the bias
alone. Labels of one class only: the score is that class's share. Repeated rows get equal rows.
Null ids are never held out and never labelled. Texts are read whole. An empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import map_slices, slices, texts_of, typed
from talentlake.llm.labelled import fold, labelled_sample, logistic
from talentlake.workspace import stored

MAX_LABELLED = 20_000
DISCOUNT = 2
SHARED_WEIGHT = 0.995
CALIBRATION_FOLD = 1
ORDINARY, TOXIC = 0, 1
PENDING_WORDS = 200_000

_WORD = re.compile(r"[^\W_]+")
_START = ""  # stands before a text's first word


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _digest(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) - 2**63


def continuations(labelled: DataFrame) -> DataFrame:
    """(label, word, n): the distinct words that a word follows in the texts of a label."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        seen = set()
        for text, label in zip(texts_of(batch), batch.column("label").to_pylist()):
            words = words_of(text)
            seen.update((label, word, before) for before, word in zip([_START, *words], words))
        return {
            "label": pa.array([label for label, _, _ in seen], pa.int32()),
            "word": pa.array([word for _, word, _ in seen], pa.string()),
            "before": pa.array([_digest(before) for _, _, before in seen], pa.int64()),
        }

    pairs = map_slices(labelled, run, "label int, word string, before bigint").distinct()
    return pairs.groupBy("label", "word").agg(F.count("*").alias("n"))


def shared_counts(docs: DataFrame, words: set[str]) -> DataFrame:
    """(word, n) of the words in all texts; the word null stands for all of them together."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total, seen, every = shared.value, Counter(), Counter(), 0

        def settle() -> None:
            total.update({word: n for word, n in seen.items() if word in wanted})
            seen.clear()

        for batch in slices(batches):
            for text in texts_of(batch):
                found = words_of(text)
                seen.update(found)
                every += len(found)
            if len(seen) > PENDING_WORDS:
                settle()
        settle()
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array([None, *total], pa.string()), "n": pa.array([every, *total.values()], pa.int64())}
        )

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Difference of the classes' log-probabilities by word, that of all other words, and
    calibration: weights of the difference per word, of the logarithm of the words, of their
    product, and the bias."""

    words: dict[str, float]
    other: float
    calibration: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0, 0.0]))

    @classmethod
    def fit(cls, own: list[dict[str, int]], totals: list[tuple[int, int]], shared: dict[str, int], every: int) -> Model:
        """``own``: by class the continuation counts above the discount; ``totals``: by class the
        sum of all counts, and of what the discount takes from them."""
        known = sorted(own[ORDINARY].keys() | own[TOXIC].keys())
        backoff = np.array([shared.get(word, 0) + 0.5 for word in known]) / (every + 1.0)
        logs, others = [], []
        for counts, (total, taken) in zip(own, totals):
            left = taken / total if total else 1.0
            kept = np.array([max(counts.get(word, 0) - DISCOUNT, 0) for word in known]) / max(total, 1)
            logs.append(np.log((1 - SHARED_WEIGHT) * (kept + left * backoff) + SHARED_WEIGHT * backoff))
            others.append(math.log((1 - SHARED_WEIGHT) * left + SHARED_WEIGHT))
        difference = logs[TOXIC] - logs[ORDINARY]
        return cls(dict(zip(known, difference.tolist())), others[TOXIC] - others[ORDINARY])

    def measure(self, texts: list[str]) -> np.ndarray:
        """Toxic less ordinary log-likelihood per word (0 without words) and what goes with it."""
        out = np.zeros((len(texts), 3))
        get, other = self.words.get, self.other
        for i, text in enumerate(texts):
            words = words_of(text)
            if words:
                # In units that the calibration's steps and ridge are made for.
                difference = sum([get(word, other) for word in words]) / len(words) / (1 - SHARED_WEIGHT)
                size = math.log1p(len(words))
                out[i] = difference, size, difference * size
        return out

    def score(self, texts: list[str]) -> np.ndarray:
        z = self.measure(texts) @ self.calibration[:-1] + self.calibration[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_labelled: int = MAX_LABELLED,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    """A model of ``labels`` (1 toxic, 0 ordinary) on the texts of ``docs``."""
    chosen = labelled_sample(labels, F.col(label).cast("int"), max_labelled, doc_id)
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    sizes = {row["label"]: row["count"] for row in chosen.groupBy("label").count().collect()}
    least = min(sizes.get(ORDINARY, 0), sizes.get(TOXIC, 0))
    share = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    # The sample is at most max_labelled rows; its texts are stored, to be read twice.
    labelled = stored(
        read.join(F.broadcast(chosen), "doc_id").select("text", "label", fold("doc_id").alias("fold"), share.alias("share")),
        "labelled",
    )
    taken = F.lit(False)
    for value, rows in sizes.items():
        taken = taken | ((F.col("label") == value) & (F.col("share") * rows < least))
    learned = labelled.where((F.col("fold") != CALIBRATION_FOLD) & taken).select("text", "label")
    counts = stored(continuations(learned), "continuations")
    sums = {
        row["label"]: (row["total"], row["taken"])
        for row in counts.groupBy("label")
        .agg(F.sum("n").alias("total"), F.sum(F.least("n", F.lit(DISCOUNT))).alias("taken"))
        .collect()
    }
    own: list[dict[str, int]] = [{}, {}]
    for batch in counts.where(F.col("n") > DISCOUNT).toArrow().to_batches():
        for value, word, n in zip(*(batch.column(name).to_pylist() for name in ("label", "word", "n"))):
            own[value][word] = n
    words = own[ORDINARY].keys() | own[TOXIC].keys()
    everywhere = shared_counts(read, words).toArrow().to_pydict()
    shared = dict(zip(everywhere["word"], everywhere["n"]))
    every = shared.pop(None, 0)
    model = Model.fit(own, [sums.get(ORDINARY, (0, 0)), sums.get(TOXIC, (0, 0))], shared, every)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batch: pa.RecordBatch) -> dict[str, object]:
        columns = sent.value.measure(texts_of(batch)).T
        return {"label": batch.column("label"), **{name: column for name, column in zip("abc", columns)}}

    held = labelled.where(F.col("fold") == CALIBRATION_FOLD).select("text", "label")
    seen = map_slices(held, measure, "label int, a double, b double, c double").toArrow()
    if seen.num_rows:
        x = np.column_stack([seen.column(name).to_numpy() for name in "abc"])
        model.calibration = logistic(x, seen.column("label").to_numpy())
    sent.unpersist()
    return model


def toxicity(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``score`` from 0 to 1, ``predicted`` 0 or 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batch: pa.RecordBatch) -> dict[str, object]:
        score = shared.value.score(texts_of(batch))
        return {"doc_id": batch.column("doc_id"), "score": score, "predicted": (score >= 0.5).astype(np.int32)}

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_slices(read, measure, f"doc_id {typed(read, 'doc_id')}, score double, predicted int")
