"""Packing against a plain tokenizer and a plain concatenation."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from talentlake.llm.packing import WordTokenizer, pack
from talentlake.llm.queries import QUERIES, tokenizer_path

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, part string, ids string, before int"
TEXTS = [
    "It's we'll THEY'VE don't 'sa ''s x't",
    "Straße ÉCOLE naïve ſ ŉ ªº ²³ ¼ 12 345",
    "İstanbul ΟΔΟΣ Σ日本語 é \xa0\x85 x",
    "a<|endoftext|>b <|startoftext|>",
    "### $$$ %%% !!... --- \x0b\x0c\x1c z\xadz",
    "",
    " \n\t ",
    "</w> w</w>",
]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_equal_the_tokenizers(plain):
    ours = WordTokenizer(tokenizer_path())
    for text in [*TEXTS, " ".join(TEXTS), *TEXTS]:
        expected = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ours.encode(text), "<u4").tolist() == expected, text


def test_what_is_new_is_learnt_in_one_go(plain):
    ours, calls = WordTokenizer(tokenizer_path()), []
    encode = ours.tokenizer.encode_batch_fast

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(texts)
            return encode(texts, **options)

    texts = ["one two, two", "", "two; three", "one four"]
    ours.tokenizer = Counted()
    for _ in range(2):
        found = [np.frombuffer(ids, "<u4").tolist() for ids in ours.encode_all(texts)]
        assert found == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(calls) == 1
    ours.tokenizer = plain
    assert [np.frombuffer(x, "<u4").tolist() for x in ours.encode_all(TEXTS)] == [plain.encode(t, add_special_tokens=False).ids for t in TEXTS]


def check(pieces, texts, plain, length):
    """Every id in one piece; sequences gapless and full but for the last."""
    expected = {k: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for k, t in texts.items()}
    for key, ids in expected.items():
        own = sorted((p for p in pieces if p["doc_id"] == key), key=lambda p: p["start"])
        joined = b"".join(bytes(p["ids"]) for p in own)
        assert np.frombuffer(joined, "<u4").tolist() == ids
        assert [p["start"] for p in own] == [sum(q["length"] for q in own[:i]) for i in range(len(own))]
        assert {p["doc_tokens"] for p in own} == {len(ids)}
    sizes = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == sizes.get(p["sequence_id"], 0)
        sizes[p["sequence_id"]] = p["offset"] + p["length"]
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(size == length for key, size in sizes.items() if key < len(sizes) - 1)
    assert sum(sizes.values()) == sum(map(len, expected.values()))


def test_edge_cases(spark, plain):
    texts = {i: t for i, t in enumerate(TEXTS)} | {None: None, 90: "word " * 5000}
    rows = [(k, t, "en", "x", "y", 1) for k, t in texts.items()]
    pieces = pack(spark.createDataFrame(rows, SCHEMA), tokenizer_path(), length=64).collect()
    check(pieces, texts, plain, 64)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "some words", "en", "x", "y", 1)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(p["offset"] for p in pack(df, tokenizer_path()).collect()) == [0, 3, 6]
    assert pack(df.limit(0), tokenizer_path()).collect() == []


def test_query(spark, plain):
    rows = QUERIES["op5_concatenate_and_cut"](spark, DATA).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    expected = {k: np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4") for k, t in texts.items()}
    for r in rows:
        ids = expected[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in rows) == sum(map(len, expected.values()))
