"""Sampled segmentations: exact round trips, all paths of short texts, sampling without replacement."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from talentlake.llm import segmentations
from talentlake.llm.queries import QUERIES, tokenizer_path
from talentlake.llm.segmentations import Pieces, decode, encode, sample

SCHEMA = "doc_id bigint, text string, sample string, ids string, log_prob int"
PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return Pieces(PATH, 1.0)


def ids_of(raw):
    return tuple(np.frombuffer(raw, "<u4").tolist())


def all_paths(model, text):
    """Log-probability of every segmentation, by plain recursion over whole text."""
    normal = model.processor.normalize(text)

    def paths(at):
        if at == len(normal):
            return [((), 0.0)]
        out = []
        for stop in range(at + 1, len(normal) + 1):
            i = model.pieces.get(normal[at:stop])
            if i is not None:
                out += [((i, *rest), model.weights[i] + w) for rest, w in paths(stop)]
        return out

    found = paths(0)
    total = math.log(sum(math.exp(w) for _, w in found))
    return {ids: w - total for ids, w in found}


def test_all_segmentations_of_a_short_text(model):
    for text in ("the cat", "abab", "a b"):
        expected = all_paths(model, text)
        found = sample(model, [text], [3], len(expected) + 5)[0]
        assert {ids_of(ids): pytest.approx(lp) for ids, lp, _, _ in found} == expected
        assert all(score == 0.0 for *_, score in found[-1:])
        assert sum(math.exp(lp) for _, lp, _, _ in found) == pytest.approx(1)


def test_first_samples_follow_the_probabilities_and_scores_are_unbiased(model):
    expected = all_paths(model, "the cat")
    n = 4000
    first, estimate = Counter(), Counter()
    for out in sample(model, ["the cat"] * n, list(range(n)), 3):
        assert len({ids for ids, *_ in out}) == 3
        assert [g for _, _, g, _ in out] == sorted((g for _, _, g, _ in out), reverse=True)
        first[ids_of(out[0][0])] += 1
        for ids, lp, _, score in out:
            estimate[ids_of(ids)] += math.exp(lp - score)
    for ids, lp in expected.items():
        p = math.exp(lp)
        assert first[ids] / n == pytest.approx(p, abs=5 * math.sqrt(p * (1 - p) / n) + 1e-3)
        assert estimate[ids] / n == pytest.approx(p, abs=0.05)


TEXTS = {
    1: "Hello  world\nfoo é 𝄞 <s> x",
    2: "",
    3: None,
    4: " \t ",
    5: "日本語のテキスト ǆ ſ \x00 <0x41>",
    6: "word " * 3000 + "x" * 3000,
    None: "no id",
}


def test_round_trip_in_spark(spark, model):
    rows = [(k, t, "s", "i", 1) for k, t in TEXTS.items()] + [(1, TEXTS[1], "s", "i", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    samples = encode(docs, PATH, k=4)
    out = samples.withColumn("text", decode(F.col("ids"), PATH)).collect()
    for r in out:
        text = TEXTS[r["doc_id"]] or ""
        assert r["text"] == model.processor.decode(model.processor.encode(text))
        assert -math.inf < r["log_inclusion"] <= 0
    assert {r["doc_id"] for r in out} == set(TEXTS)
    per_row = Counter(r["doc_id"] for r in out)
    assert per_row[2] == per_row[3] == 1 and per_row[6] == 4 and per_row[1] == 8
    # A row's samples do not depend on the rows around it.
    alone = {bytes(r["ids"]) for r in encode(docs.where("doc_id = 6"), PATH, k=4).collect()}
    assert alone == {bytes(r["ids"]) for r in out if r["doc_id"] == 6}
    assert encode(docs.limit(0), PATH).collect() == []


def test_looking_at_likely_prefixes_first_changes_nothing(model, monkeypatch):
    texts = ["word " * 400 + "x" * 500, "the cat", "Ünïcödé 日本 " * 60, "a b c " * 900, "", "q"]
    found = sample(model, texts, [11, 12, 13, 14, 15, 16], 6)
    monkeypatch.setattr(segmentations, "WINDOW", 1e9)
    assert sample(model, texts, [11, 12, 13, 14, 15, 16], 6) == found


def test_query(spark, model):
    data = "/root/testdata/sf0.001"
    rows = QUERIES["op9_gumbel_segmentations"](spark, data).collect()
    docs = spark.read.parquet(f"{data}/documents.parquet")
    whole = encode(docs, PATH).withColumn("text", decode(F.col("ids"), PATH)).collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["text"] == model.processor.decode(model.processor.encode(texts[r["doc_id"]] or "")) for r in whole)
    expected = sorted((r["doc_id"], r["sample"], len(r["ids"]) // 4, zlib.crc32(r["ids"]), r["log_prob"]) for r in whole)
    assert sorted((r["doc_id"], r["sample"], r["n_ids"], r["ids_crc32"], r["log_prob"]) for r in rows) == expected
    assert {r["doc_id"] for r in rows} == set(texts)
    # A sample's log-probability is that of its pieces, up to the text's own constant.
    for i in [r["doc_id"] for r in rows][:40]:
        pair = [r for r in whole if r["doc_id"] == i]
        if len(pair) == 2 and not any(model.processor.is_byte(int(p)) for r in pair for p in np.frombuffer(r["ids"], "<u4")):
            weight = [sum(model.weights[p] for p in ids_of(r["ids"])) for r in pair]
            assert weight[0] - weight[1] == pytest.approx(pair[0]["log_prob"] - pair[1]["log_prob"], abs=1e-6)


def test_lattices_of_words_are_kept_for_later_texts(model, monkeypatch):
    expected = sample(model, ["three one", ""], [3, 4], 3)
    calls = []
    learn = segmentations.Lexicon._learn
    monkeypatch.setattr(segmentations.Lexicon, "_learn", lambda self, model, words: (calls.append(list(words)), learn(self, model, words)))
    fresh = Pieces(PATH, 1.0)
    first = sample(fresh, ["one two two", "日本 three"], [1, 2], 3)
    assert calls == [["▁one", "▁two", "▁日本", "▁three"]]
    assert sample(fresh, ["three one", ""], [3, 4], 3) == expected
    assert sample(fresh, ["one two two", "日本 three"], [1, 2], 3) == first
    assert len(calls) == 1


def test_a_full_table_forgets_and_samples_stay(model, monkeypatch):
    texts = [f"the cat {'ab' * i} é日 word{i} x" for i in range(60)]
    expected = sample(model, texts, list(range(60)), 3)
    for most in (10, 400, 1500):
        monkeypatch.setattr(segmentations, "REMEMBERED_EDGES", most)
        fresh = Pieces(PATH, 1.0)
        sizes = []
        for turn in range(3):
            found = [sample(fresh, [text], [key], 3)[0] for key, text in enumerate(texts)]
            sizes.append(len(fresh.lexicon.source))
            assert found == expected
        assert max(sizes) <= most


def test_words_are_split_as_by_the_pattern():
    texts = ["", "▁a▁▁b", "▁", "a", "▁▁", "▁x▁", "日▁本▁▁", "", "▁é"]
    words, counts = segmentations.split_words(texts)
    expected = [re.findall("▁*[^▁]+|▁+", text) for text in texts]
    assert words.to_pylist() == [w for ws in expected for w in ws]
    assert counts.tolist() == [len(ws) for ws in expected]
    assert segmentations.split_words(["", ""])[1].tolist() == [0, 0]
