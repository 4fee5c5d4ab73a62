"""Quality by ordinal cumulative-link regression on graded ratings.

Shared weights over hashed text make one number of a text; ordered thresholds turn it into the
probability of each grade: P(grade <= k) = logistic(threshold_k - number). From these follow the
expected grade, and the tail probability by which texts are selected.

Features: trigrams of characters and trigrams of their classes, hashed, as shares of the text;
and seven ratios of the whole text (distinct words, repeats, lengths). The fit takes at most ``max_labelled`` rated rows outside the
held-out fold (a documented bound; the sample is broadcast to one scan and its hashed features
are collected). Scoring is one narrow pass that shuffles nothing: a text's number is the mean
of its trigrams' weights, so no feature is stored.

Null or empty text: the ratios are 0, so it has the number of an empty text. Ratings that are
null, below 0 or above the highest grade are left out; without any rating every grade is
equally likely. Repeated rows get equal rows. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import unicodedata
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import first_of, map_slices, slices, texts_of
from talentlake.llm.labelled import labelled_sample

MAX_LABELLED = 6_000
GRADES = 3
TAIL_GRADE = 1
MIN_TAIL = 0.5
BUCKETS = 1 << 15  # of each kind of trigram
SCALE = 30.0
RATIOS = 7
STEPS = 150
# Bytes of texts that are hashed at once: every character becomes about fifty bytes of arrays.
HASHED_BYTES = 250_000


def _classes() -> np.ndarray:
    """Class of each code point below 2^14: letters by case, digits, white space, others as themselves."""
    out = np.zeros(1 << 14, dtype=np.uint32)
    kinds = {"Ll": 1, "Lo": 1, "Lm": 1, "Lu": 2, "Lt": 2, "Nd": 3, "No": 3, "Nl": 3, "Zs": 4}
    for code in range(len(out)):
        c = chr(code)
        out[code] = 5 if c in "\n\r" else 4 if c.isspace() else kinds.get(unicodedata.category(c), 16 + code)
    return out


_CLASSES = _classes()


def _trigrams(codes: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that ends at each place."""
    x = codes.astype(np.uint32)
    h = x * np.uint32(0x9E3779B1) + np.roll(x, 1) * np.uint32(0x85EBCA6B) + np.roll(x, 2) * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(12)) & np.uint32(BUCKETS - 1)


def _ratios(text: str) -> tuple[float, ...]:
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    if not words:
        return (0.0,) * RATIOS
    distinct = len(set(words)) / len(words)
    return (
        distinct,
        float(distinct < 0.5),
        float(distinct < 0.25),
        sum(map(eq, words, words[1:])) / len(words),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        math.log1p(len(words)) / 10,
        min(len(text) / len(words) / 20, 2.0),
    )


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of both trigrams at every character of all texts, where texts start and end, ratios."""
    padded = ["\n\n" + text for text in texts]
    sizes = np.fromiter(map(len, padded), dtype=np.int64, count=len(padded))
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    ends = np.cumsum(sizes)
    spans = np.stack([ends - sizes + 2, ends], axis=1)
    classes = np.where(codes < len(_CLASSES), _CLASSES[np.minimum(codes, len(_CLASSES) - 1)], 1)
    ratios = np.array([_ratios(text) for text in texts], dtype=np.float64).reshape(len(texts), RATIOS)
    return _trigrams(codes), _trigrams(classes) + np.uint32(BUCKETS), spans, ratios


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    weights: np.ndarray  # of the buckets of both trigrams
    ratios: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    @classmethod
    def fit(cls, x: list[np.ndarray], n: list[np.ndarray], ratios: np.ndarray, grade: np.ndarray, grades: int = GRADES) -> Model:
        """Maximum likelihood with a small ridge, by full-batch Adam. ``x`` and ``n``: each
        text's buckets and their scaled shares."""
        even = np.log(np.arange(1, grades) / np.arange(grades - 1, 0, -1))
        if not len(grade):
            return cls(np.zeros(2 * BUCKETS), np.zeros(RATIOS), even)
        cell, share = np.concatenate(x), np.concatenate(n)
        row = np.repeat(np.arange(len(x)), [len(b) for b in x])
        below = np.array([(grade <= k).mean() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
        first = np.log(below / (1 - below))
        gaps = np.log(np.maximum(np.diff(first), 1e-2))
        p = np.concatenate([np.zeros(2 * BUCKETS + RATIOS), first[:1], gaps])
        at = 2 * BUCKETS
        m, v = np.zeros_like(p), np.zeros_like(p)
        for step in range(1, STEPS + 1):
            theta = p[at + RATIOS] + np.concatenate([[0.0], np.cumsum(np.exp(p[at + RATIOS + 1 :]))])
            eta = np.bincount(row, p[cell] * share, minlength=len(x)) + ratios @ p[at : at + RATIOS]
            edge = _logistic(np.concatenate([[-1e9], theta, [1e9]])[None, :] - eta[:, None])
            edge[:, 0], edge[:, -1] = 0.0, 1.0
            rows = np.arange(len(x))
            upper, lower = edge[rows, grade + 1], edge[rows, grade]
            mass = np.maximum(upper - lower, 1e-12)
            du, dl = upper * (1 - upper) / mass, lower * (1 - lower) / mass
            d_eta = (du - dl) / len(x)
            d_theta = np.array([dl[grade == k + 1].sum() - du[grade == k].sum() for k in range(grades - 1)]) / len(x)
            g = 1e-5 * p
            g[: 2 * BUCKETS] += np.bincount(cell, d_eta[row] * share, minlength=2 * BUCKETS)
            g[at : at + RATIOS] += ratios.T @ d_eta
            g[at + RATIOS] += d_theta.sum()
            for k in range(grades - 2):
                g[at + RATIOS + 1 + k] += np.exp(p[at + RATIOS + 1 + k]) * d_theta[k + 1 :].sum()
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        theta = p[at + RATIOS] + np.concatenate([[0.0], np.cumsum(np.exp(p[at + RATIOS + 1 :]))])
        return cls(p[:at].astype(np.float32), p[at : at + RATIOS], theta)

    def at_most(self, texts: list[str]) -> np.ndarray:
        """P(grade <= k) of every text, a column for each grade but the highest."""
        chars, classes, spans, ratios = features(texts)
        total = np.concatenate([[0.0], np.cumsum(self.weights[chars] + self.weights[classes], dtype=np.float64)])
        size = np.maximum(spans[:, 1] - spans[:, 0], 1)
        eta = SCALE * (total[spans[:, 1]] - total[spans[:, 0]]) / size + ratios @ self.ratios
        return _logistic(self.thresholds[None, :] - eta[:, None])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    grades: int = GRADES,
    max_labelled: int = MAX_LABELLED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Model:
    """A model of graded ratings, 0 to ``grades - 1``, on the texts of ``docs``."""
    rated = labels.where(grade.between(0, grades - 1))
    chosen = labelled_sample(rated, grade.cast("int"), max_labelled, doc_id)

    def hashed(batch: pa.RecordBatch) -> dict[str, object]:
        chars, classes, spans, ratios = features(texts_of(batch))
        cells, shares = [], []
        for start, end in spans.tolist():
            both = np.concatenate([chars[start:end], classes[start:end]])
            cell, count = np.unique(both, return_counts=True)
            cells.append(cell.astype(np.int32))
            shares.append((SCALE * count / max(end - start, 1)).astype(np.float32))
        return {
            "grade": batch.column("label"),
            "cells": pa.array(cells, type=pa.list_(pa.int32())),
            "shares": pa.array(shares, type=pa.list_(pa.float32())),
            "ratios": pa.array(list(ratios), type=pa.list_(pa.float64())),
        }

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    # The sample is at most max_labelled rows.
    sample = read.join(F.broadcast(chosen), "doc_id").select("text", "label")
    rows = map_slices(sample, hashed, "grade int, cells array<int>, shares array<float>, ratios array<double>").toArrow()

    def arrays(name: str) -> list[np.ndarray]:
        column = rows.column(name).combine_chunks()
        values, offsets = column.values.to_numpy(), column.offsets.to_numpy()
        return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]

    if not rows.num_rows:
        return Model.fit([], [], np.zeros((0, RATIOS)), np.zeros(0, dtype=int), grades)
    return Model.fit(arrays("cells"), arrays("shares"), np.stack(arrays("ratios")), rows.column("grade").to_numpy(), grades)


def quality(
    docs: DataFrame,
    model: Model,
    tail_grade: int = TAIL_GRADE,
    min_tail: float = MIN_TAIL,
    text: str = "text",
) -> DataFrame:
    """``docs``, all columns, with ``expected_grade``, ``tail`` (probability of ``tail_grade``
    or better) and ``selected``; these names must be free (``first_of`` finds free ones)."""
    name = first_of(["graded"], docs.columns)["graded"]
    graded = _graded(docs, name, model, tail_grade, text)
    return graded.select(
        *docs.columns,
        F.col(f"{name}.expected").alias("expected_grade"),
        F.col(f"{name}.tail").alias("tail"),
        (F.col(f"{name}.tail") >= min_tail).alias("selected"),
    )


def _graded(docs: DataFrame, name: str, model: Model, tail_grade: int, text: str) -> DataFrame:
    """``docs`` with a struct column of the expected grade and the tail probability."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def grades(texts: pa.Array) -> pa.Array:
        names = ["expected", "tail"]
        if not len(texts):
            return pa.StructArray.from_arrays([pa.array([], pa.float64())] * 2, names=names)
        parts = []
        column = pa.RecordBatch.from_arrays([texts], names=["text"])
        for batch in slices(iter([column]), size=HASHED_BYTES):
            at_most = shared.value.at_most(texts_of(batch))
            parts.append(np.stack([(1 - at_most).sum(axis=1), 1 - at_most[:, tail_grade - 1]]))
        both = np.concatenate(parts, axis=1)
        return pa.StructArray.from_arrays([pa.array(both[0]), pa.array(both[1])], names=names)

    return docs.withColumn(name, F.arrow_udf(grades, "struct<expected:double,tail:double>")(F.col(text)))


def selected(docs: DataFrame, model: Model, tail_grade: int = TAIL_GRADE, min_tail: float = MIN_TAIL, text: str = "text") -> DataFrame:
    """Rows of ``docs``, columns as they are, whose tail probability is high enough."""
    name = first_of(["graded"], docs.columns)["graded"]
    graded = _graded(docs, name, model, tail_grade, text)
    return graded.where(F.col(f"{name}.tail") >= min_tail).select(*docs.columns)
