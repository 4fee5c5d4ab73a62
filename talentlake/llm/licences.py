"""Licence scans by a trained paragraph classifier.

Sparse multinomial logistic regression over hashed word uni- and bigrams tells licence families
from each other and from ``unknown``. It is trained on notices (below) with words dropped, swapped
and put around them, and on ordinary paragraphs of the corpus. A temperature fitted on paragraphs
outside the training calibrates the probabilities, and a window is unknown where that class is
more probable than it is on ``NOTICE_SHARE`` of the notices outside the training. A predicted
family must then be confirmed: enough word pairs of one of its notices must occur in
the paragraph. Paragraphs are lines; long ones are read in overlapping windows of ``WINDOW``
words, so that a notice inside a long paragraph is not diluted.

The fit takes at most ``max_paragraphs`` paragraphs of at most ``max_docs`` documents (documented
bounds; the ids are broadcast). Scanning is one narrow pass over whole texts and shuffles nothing.

Null or empty text: no notice. Null ids and repeated rows: scanned like any other row. An empty
table gives an empty result; the classifier is then trained on notices alone.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import map_slices, texts_of, typed

MAX_DOCS = 1_000
MAX_PARAGRAPHS = 3_000
VARIANTS = 30
BUCKETS = 1 << 16
WINDOW = 24
STRIDE = 8  # a notice of up to WINDOW - STRIDE words lies whole in some window
MIN_SHARE = 0.6
NOTICE_SHARE = 0.995
STEPS = 100
UNKNOWN = "unknown"

# Customary short notices of licence families.
NOTICES = {
    "agpl-3.0": ["licensed under the gnu affero general public license version 3", "released under the agpl version 3"],
    "apache-2.0": [
        "licensed under the apache license version 2.0",
        "you may not use this file except in compliance with the license",
        "spdx license identifier apache 2.0",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted",
        "released under the bsd license",
        "use of this source code is governed by a bsd style license",
    ],
    "cc-by": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "cc-by-nc": [
        "licensed under cc by nc 4.0",
        "this work is licensed under a creative commons attribution noncommercial 4.0 international license",
    ],
    "cc-by-sa": [
        "licensed under cc by sa 4.0",
        "this work is licensed under a creative commons attribution sharealike 4.0 international license",
    ],
    "cc0": ["this work is dedicated to the public domain under cc0 1.0", "released into the public domain"],
    "gpl-2.0": ["licensed under the gnu general public license version 2", "released under the gpl version 2"],
    "gpl-3.0": [
        "this work is licensed under the gnu general public license version 3",
        "released under the gpl version 3",
        "you can redistribute it and or modify it under the terms of the gnu general public license",
    ],
    "lgpl": ["licensed under the gnu lesser general public license", "released under the lgpl"],
    "mit": [
        "released under the mit license",
        "licensed under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
    ],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license v 2.0", "licensed under the mozilla public license version 2.0"],
    "proprietary": ["all rights reserved", "proprietary and confidential", "unauthorized copying is strictly prohibited"],
}
CLASSES = [UNKNOWN, *NOTICES]

_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+")


class Codes(dict):
    """crc32 of a word, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = value = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return value


_codes = Codes()  # of this worker


def paragraph_words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def codes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(_codes.__getitem__, words), dtype=np.uint32, count=len(words))


def _pairs(x: np.ndarray) -> np.ndarray:
    """Hash of each word with the one before it; the first stands alone."""
    before = np.concatenate([np.zeros(1, np.uint32), x[:-1]]) if len(x) else x
    h = (before * np.uint32(0x9E3779B1)) ^ x
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
    return h ^ (h >> np.uint32(13))


def features(x: np.ndarray) -> np.ndarray:
    """Buckets of a window's words and word pairs; a pair across its start does not count."""
    return np.concatenate([x % np.uint32(BUCKETS), _pairs(x)[1:] % np.uint32(BUCKETS)]).astype(np.int64)


_TEMPLATES = {name: [np.unique(_pairs(codes(paragraph_words(n)))[1:]) for n in notices] for name, notices in NOTICES.items()}


def share_of_notice(family: str, x: np.ndarray) -> float:
    """Largest share of a notice's word pairs that a window holds."""
    pairs = _pairs(x)[1:]
    return max(np.isin(notice, pairs).mean() for notice in _TEMPLATES[family])


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class Model:
    weights: np.ndarray  # bucket by class
    bias: np.ndarray
    temperature: float = 1.0
    most_unknown: float = 0.5  # probability of unknown above which a window is unknown

    @classmethod
    def fit(cls, ordinary: list[list[str]], seed: int = 5) -> Model:
        """Trained on varied notices and ordinary windows; every fifth row calibrates."""
        rng = np.random.default_rng(seed)
        filler = [word for words in ordinary for word in words][:100_000] or ["text"]
        rows, y = [], []
        for k, notices in enumerate(NOTICES.values(), 1):
            for notice in notices:
                for variant in range(VARIANTS):
                    words = notice.split()
                    if variant:
                        words = [w for w in words if rng.random() > 0.05]
                        room = rng.integers(0, max(WINDOW - len(words), 0) + 1)
                        around = rng.choice(filler, room).tolist()
                        cut = rng.integers(0, room + 1)
                        words = [*around[:cut], *words, *around[cut:]]
                    rows.append(features(codes(paragraph_words(" ".join(words)))))
                    y.append(k)
        rows += [features(codes(words)) for words in ordinary]
        y = np.array([*y, *[0] * len(ordinary)])
        held = np.arange(len(y)) % 5 == 4
        model = cls._train([rows[i] for i in np.flatnonzero(~held)], y[~held])
        if held.any():
            z, truth = np.stack([model.logits(rows[i]) for i in np.flatnonzero(held)]), y[held]
            losses = {t: -np.log(_softmax(z / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in (0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0)}
            model.temperature = min(losses, key=losses.get)
            unknown = _softmax(z[truth > 0] / model.temperature)[:, 0]
            model.most_unknown = float(max(0.5, np.quantile(unknown, NOTICE_SHARE))) if len(unknown) else 0.5
        return model

    @classmethod
    def _train(cls, rows: list[np.ndarray], y: np.ndarray) -> Model:
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        cell, at = np.unique(np.concatenate(rows), return_inverse=True)
        share = (1 / np.sqrt(np.maximum([len(r) for r in rows], 1)))[row].astype(np.float32)
        k = len(CLASSES)
        w, b = np.zeros((len(cell), k), dtype=np.float32), np.zeros(k, dtype=np.float32)
        truth = np.eye(k, dtype=np.float32)[y]
        # Notices together count as much as ordinary text.
        half = np.where(y == 0, max((y == 0).sum(), 1), max((y > 0).sum(), 1))
        mass = (0.5 / half).astype(np.float32)[:, None]
        moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, b)]
        order = np.argsort(at, kind="stable")
        starts = np.flatnonzero(np.diff(at[order], prepend=-1))
        row_starts = np.flatnonzero(np.diff(row, prepend=-1))
        for step in range(1, STEPS + 1):
            z = np.zeros((len(rows), k), dtype=np.float32)
            z[row[row_starts]] = np.add.reduceat(w[at] * share[:, None], row_starts, axis=0)
            error = (_softmax(z + b) - truth) * mass
            gradient = np.add.reduceat((error[row] * share[:, None])[order], starts, axis=0) + 1e-6 * w
            for p, g, (m, v) in ((w, gradient, moments[0]), (b, error.sum(axis=0), moments[1])):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                p -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        weights = np.zeros((BUCKETS, k), dtype=np.float32)
        weights[cell] = w
        return cls(weights, b.astype(np.float64))

    def logits(self, row: np.ndarray) -> np.ndarray:
        return self.weights[row].sum(axis=0) / np.sqrt(max(len(row), 1)) + self.bias

    def windows(self, paragraphs: list[list[str]]) -> list[tuple[int, str, float]]:
        """(paragraph, family, probability among families) of every window with a confirmed one."""
        at, start, size = [], [], []
        base = 0
        for i, words in enumerate(paragraphs):
            for begin in range(0, max(len(words) - WINDOW + STRIDE, 1), STRIDE) if words else ():
                at.append(i)
                start.append(base + begin)
                size.append(min(WINDOW, len(words) - begin))
            base += len(words)
        if not at:
            return []
        x = codes([word for words in paragraphs for word in words])
        one, two = x % np.uint32(BUCKETS), _pairs(x) % np.uint32(BUCKETS)
        starts, sizes = np.array(start), np.array(size)
        ends = starts + sizes
        sums = np.zeros((len(x) + 1, len(CLASSES)))
        np.cumsum(self.weights[one] + self.weights[two], axis=0, dtype=np.float64, out=sums[1:])
        # A window's first word stands without its pair.
        z = sums[ends] - sums[starts] - self.weights[two[starts]]
        z = z / np.sqrt(2 * sizes - 1)[:, None] + self.bias
        p = _softmax(z / self.temperature)
        best = 1 + p[:, 1:].argmax(axis=1)
        found = []
        for i in np.flatnonzero(p[:, 0] <= self.most_unknown).tolist():
            family = CLASSES[best[i]]
            if share_of_notice(family, x[starts[i] : ends[i]]) >= MIN_SHARE:
                found.append((at[i], family, float(p[i, best[i]] / (1 - p[i, 0]))))
        return found


def fit(docs: DataFrame, max_docs: int = MAX_DOCS, max_paragraphs: int = MAX_PARAGRAPHS, doc_id: str = "doc_id", text: str = "text") -> Model:
    """A model trained on notices and on ordinary paragraphs of ``docs``."""
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    chosen = read.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(max_docs).distinct()

    def ordinary(batch: pa.RecordBatch) -> dict[str, object]:
        out = []
        for body in texts_of(batch):
            for paragraph in body.split("\n"):
                words = paragraph_words(paragraph)
                out += [" ".join(words[at : at + WINDOW]) for at in range(0, len(words), WINDOW)]
        return {"words": pa.array(out, type=pa.string())}

    # The chosen ids are at most max_docs.
    rows = map_slices(read.join(F.broadcast(chosen), "doc_id").select("text"), ordinary, "words string").distinct()
    taken = rows.orderBy(F.xxhash64("words"), "words").limit(max_paragraphs).toArrow().column("words").to_pylist()
    windows = [words.split(" ") for words in sorted(taken)]
    return Model.fit([w for w in windows if all(share_of_notice(f, codes(w)) < 0.5 for f in NOTICES)])


def licences(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``notices``, an array of (paragraph, family,
    probability), by paragraph, one for each family that a paragraph names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("paragraph", pa.int32()), ("family", pa.string()), ("probability", pa.float64())]))

    def scan(batch: pa.RecordBatch) -> dict[str, object]:
        paragraphs, owner, number = [], [], []
        for i, body in enumerate(texts_of(batch)):
            for k, paragraph in enumerate(body.split("\n")):
                paragraphs.append(paragraph_words(paragraph))
                owner.append(i)
                number.append(k)
        best: list[dict[tuple[int, str], float]] = [{} for _ in range(batch.num_rows)]
        for at, family, p in shared.value.windows(paragraphs):
            key = (number[at], family)
            best[owner[at]][key] = max(p, best[owner[at]].get(key, 0.0))
        rows = [[{"paragraph": k, "family": f, "probability": p} for (k, f), p in sorted(found.items())] for found in best]
        return {"doc_id": batch.column("doc_id"), "notices": pa.array(rows, type=kind)}

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {typed(read, 'doc_id')}, notices array<struct<paragraph:int,family:string,probability:double>>"
    return map_slices(read, scan, schema)
