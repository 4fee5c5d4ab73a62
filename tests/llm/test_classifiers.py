"""Trained operators: held-out accuracy, edge cases, link functions."""

import zlib

import numpy as np
import pytest

from talentlake.llm import licences, quality, toxicity
from talentlake.llm.queries import QUERIES, grade

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, label string, graded string, body string, score int"
NOTICES = {
    "gpl-3.0": "licensed under the gnu general public license, version 3.",
    "proprietary": "all rights reserved.",
    "cc-by-nc": "licensed under cc by-nc 4.0.",
    "mit": "released under the mit license.",
    "apache-2.0": "licensed under the apache license, version 2.0.",
}
EDGES = [(1, None), (2, ""), (3, " \n "), (None, "some words"), (4, "x " * 50_000), (5, "twice"), (5, "twice")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "l", "g", "b", 1) for r in rows], SCHEMA)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def labels(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}


def area(score, y):
    """Chance that a row of label 1 scores above one of label 0."""
    one, zero = score[y == 1], score[y == 0]
    return ((one[:, None] > zero).sum() + 0.5 * (one[:, None] == zero).sum()) / (len(one) * len(zero))


def test_quality_on_held_out_rows(spark, labels):
    rows = [r for r in QUERIES["op8_ordinal_quality"](spark, DATA).collect() if r["doc_id"] in labels and held_out(r["doc_id"])]
    y = np.array([labels[r["doc_id"]]["quality"] for r in rows])
    assert area(np.array([r["tail"] for r in rows]), y) > 0.9
    assert all(0 <= r["expected_grade"] <= 2 and r["selected"] == (r["tail"] >= 0.5) for r in rows)


def test_ordinal_fit_orders_its_grades():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 400)
    x = [np.array([g, 10]) for g in grade]
    n = [np.array([1.0, 0.2], dtype=np.float32)] * 400
    model = quality.Model.fit(x, n, np.zeros((400, quality.RATIOS)), grade, 4)
    assert (np.diff(model.thresholds) > 0).all()
    assert (np.diff(model.weights[:4]) > 0).all()


def plain_loss(p, texts, grades, n_grades):
    """Ridged mean negative log-likelihood of the ordinal model, text by text."""
    weights, ratios, thresholds = p
    total = 0.0
    for (cells, shares, own), g in zip(texts, grades):
        eta = sum(weights[c] * s for c, s in zip(cells, shares)) + float(np.dot(own, ratios))
        at_most = [0.0, *(1 / (1 + np.exp(eta - t)) for t in thresholds), 1.0]
        total -= np.log(at_most[g + 1] - at_most[g])
    return total / len(grades)


def test_ordinal_fit_is_a_maximum_of_the_likelihood():
    rng = np.random.default_rng(4)
    n, grades = 120, rng.integers(0, 3, 120)
    cells = [np.array([int(g + rng.integers(0, 2)), 10, 11]) for g in grades]
    shares = [np.array([1.0, 0.4, rng.random()], dtype=np.float32) for _ in grades]
    ratios = rng.random((n, quality.RATIOS))
    model = quality.Model.fit(cells, shares, ratios, grades, 3)
    rows = list(zip(cells, shares, ratios))
    fitted = plain_loss((model.weights, model.ratios, model.thresholds), rows, grades, 3)
    for _ in range(40):
        moved = model.weights.copy()
        moved[[0, 1, 2, 3, 10, 11]] += rng.normal(0, 0.3, 6)
        other = (moved, model.ratios + rng.normal(0, 0.3, quality.RATIOS), np.sort(model.thresholds + rng.normal(0, 0.3, 2)))
        assert plain_loss(other, rows, grades, 3) > fitted - 1e-3


def test_quality_scores_by_hand(spark):
    """Every text's number summed trigram by trigram."""
    rng = np.random.default_rng(2)
    model = quality.Model(
        rng.normal(size=2 * quality.BUCKETS).astype(np.float32), rng.normal(size=quality.RATIOS), np.array([-0.5, 0.7])
    )
    texts = ["Ab1 é日\n\nx", "one two two", "zz"]

    def bucket(a, b, c):
        m = 2**32
        h = (c * 0x9E3779B1 + b * 0x85EBCA6B + a * 0xC2B2AE35) % m
        h = ((h ^ (h >> 15)) * 0x2C1B3C6D) % m
        return (h >> 12) & (quality.BUCKETS - 1)

    def kind(c):
        return int(quality._CLASSES[ord(c)]) if ord(c) < len(quality._CLASSES) else 1

    expected = []
    for text in texts:
        padded = "\n\n" + text
        total = 0.0
        for i in range(2, len(padded)):
            total += model.weights[bucket(*(ord(c) for c in padded[i - 2 : i + 1]))]
            total += model.weights[quality.BUCKETS + bucket(*(kind(c) for c in padded[i - 2 : i + 1]))]
        eta = quality.SCALE * total / len(text) + float(np.dot(quality._ratios(text), model.ratios))
        expected.append([1 / (1 + np.exp(eta - t)) for t in model.thresholds])
    assert model.at_most(texts) == pytest.approx(np.array(expected), abs=1e-4)
    out = {r["text"]: r for r in quality.quality(frame(spark, list(enumerate(texts))), model).collect()}
    for text, (low, middle) in zip(texts, expected):
        assert out[text]["expected_grade"] == pytest.approx(2 - low - middle, abs=1e-4)
        assert out[text]["tail"] == pytest.approx(1 - low, abs=1e-4)


def test_quality_edges(spark):
    docs = frame(spark, EDGES)
    model = quality.fit(docs, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), grade())
    out = quality.quality(docs, model)
    assert out.columns == [*docs.columns, "expected_grade", "tail", "selected"]
    assert [round(r["expected_grade"], 6) for r in out.collect()] == [1.0] * len(EDGES)
    assert quality.selected(docs, model).columns == docs.columns
    assert quality.selected(docs, model).count() == len(EDGES)
    assert quality.selected(docs.limit(0), model).count() == 0


def test_toxicity_on_held_out_rows(spark, labels):
    rows = QUERIES["op4_kneser_ney"](spark, DATA).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    known = [r for r in rows if r["doc_id"] in labels and held_out(r["doc_id"])]
    score, y = np.array([r["score"] for r in known]), np.array([labels[r["doc_id"]]["toxic"] for r in known])
    assert area(score, y) > 0.8


def test_kneser_ney_by_hand():
    """Both models spelled out word by word."""
    own, shared = [{"a": 5, "b": 3}, {"a": 4, "c": 7}], {"a": 50, "b": 9, "c": 8}
    totals, every = [(20, 8), (30, 9)], 1000
    model = toxicity.Model.fit(own, totals, shared, every)

    def p(value, word):
        base = (shared[word] + 0.5) / (every + 1)
        total, taken = totals[value]
        kneser_ney = max(own[value].get(word, 0) - 2, 0) / total + taken / total * base
        return 0.005 * kneser_ney + 0.995 * base

    for word in "abc":
        assert model.words[word] == pytest.approx(np.log(p(1, word) / p(0, word)))
    assert model.words["b"] < model.other < 0 < model.words["c"]
    text = "A x b? c_c"
    expected = (model.words["a"] + model.words["b"] + 2 * model.words["c"] + model.other) / 5 / 0.005
    assert model.measure([text, ""])[:, 0] == pytest.approx([expected, 0])


def test_continuations_count_distinct_words_before(spark):
    rows = [("a b a b c b", 0), ("c b", 0), ("a b", 1), ("a b", 1), (None, 1), ("", 0)]
    docs = spark.createDataFrame(rows, "text string, label int")
    counts = {(r["label"], r["word"]): r["n"] for r in toxicity.continuations(docs).collect()}
    assert counts == {(0, "a"): 2, (0, "b"): 2, (0, "c"): 2, (1, "a"): 1, (1, "b"): 1}
    shared = {r["word"]: r["n"] for r in toxicity.shared_counts(docs.select("text"), {"a", "zz"}).collect()}
    assert shared == {None: 12, "a": 4}


def test_toxicity_finds_words(spark):
    rng = np.random.default_rng(1)
    words = [f"{a}{b}" for a in ("pla", "men", "tor", "sil", "ver") for b in ("a", "ona", "ist", "ing", "ed", "um")]
    rows, marks = [], []
    for i in range(600):
        text = rng.choice(words, 60).tolist()
        if i % 4 == 0:
            text[5], text[40] = "vile", "grubby"
        rows.append((i, " ".join(text)))
        marks.append((i, int(i % 4 == 0)))
    docs = frame(spark, [*rows, *EDGES])
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id bigint, toxic int"))
    out = toxicity.toxicity(docs, model).collect()
    held = [(r["score"], int(r["doc_id"] % 4 == 0)) for r in out[:600] if held_out(r["doc_id"])]
    assert area(np.array([s for s, _ in held]), np.array([y for _, y in held])) > 0.95
    assert len(out) == len(docs.collect())
    assert toxicity.toxicity(docs.limit(0), model).collect() == []


def test_toxicity_without_labels(spark):
    docs = frame(spark, EDGES)
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert all(0 <= r["score"] <= 1 for r in toxicity.toxicity(docs, model).collect())


def test_licences_against_literal_notices(spark):
    rows = QUERIES["op3_licence_classifier"](spark, DATA).collect()
    texts = {r["doc_id"]: r["text"].lower() for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    expected = {i: ",".join(sorted(k for k, v in NOTICES.items() if v in t)) for i, t in texts.items()}
    assert {r["doc_id"]: r["families"] for r in rows} == expected


def test_licence_edges(spark):
    ordinary = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    around = " ".join(r["text"].replace("\n", " ") for r in ordinary.where("lang = 'en'").limit(3).collect())
    notice = f"{around} You may use it. Released under the MIT License. {around}"
    docs = frame(spark, [*EDGES, (7, notice), (8, "All rights reserved\n\nLicensed under CC BY-SA 4.0")])
    model = licences.fit(ordinary)
    found = {(r["doc_id"], tuple((n["paragraph"], n["family"]) for n in r["notices"])) for r in licences.licences(docs, model).collect()}
    assert (7, ((0, "mit"),)) in found
    assert (8, ((0, "proprietary"), (2, "cc-by-sa"))) in found
    assert all(not notices for i, notices in found if i not in (7, 8))
    assert licences.licences(docs.limit(0), model).collect() == []
    licences.fit(docs)
    licences.fit(docs.limit(0))
