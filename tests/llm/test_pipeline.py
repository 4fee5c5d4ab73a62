"""The corpus pipeline, stage by stage against what each must do to its own input."""

import gc
import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from talentlake.llm import frames, quality
from talentlake.llm.line_dedup import line_words
from talentlake.llm.packing import WordTokenizer
from talentlake.llm.queries import grade, tokenizer_path
from talentlake.llm.secrets import MARK, candidates
from talentlake.llm.shingles import shingles
from talentlake.workspace import stored

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Documents before every stage, and the result."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    # These tables hold no secret, so some texts get one.
    secret = F.concat("text", F.lit(' token = "'), F.sha1(F.col("doc_id").cast("string")), F.lit('"'))
    texts = docs.withColumn("text", F.when(F.col("doc_id") % 7 == 3, secret).otherwise(F.col("text")))
    docs = spark.createDataFrame(texts.withColumn("n_chars", F.length("text").cast("long")).collect(), docs.schema)
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, docs, DATA)
        out.append(df.collect())
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert df.columns == COLUMNS
            docs = spark.createDataFrame(out[-1], docs.schema)
    return out


def by_id(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stages_are_those_asked_for():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "secrets", "packing"]


def test_quality_keeps_what_the_classifier_selects(spark, steps):
    docs = spark.createDataFrame(steps[0])
    model = quality.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"), grade())
    selected = {r["doc_id"] for r in quality.quality(docs, model).collect() if r["selected"]}
    assert set(by_id(steps[1])) == selected and 0 < len(selected) < len(steps[0])
    assert all(by_id(steps[0])[i] == text for i, text in by_id(steps[1]).items())
    good = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(good & selected) > 0.95 * len(good)


def test_no_line_repeats_an_earlier_one(steps):
    seen = set()
    for i, text in sorted(by_id(steps[2]).items()):
        for line in text.split("\n"):
            words = tuple(line_words(line))
            assert not words or words not in seen, (i, line)
            seen.add(words)
    before = by_id(steps[1])
    for i, text in by_id(steps[2]).items():
        rest = iter(before[i].split("\n"))
        assert all(line in rest for line in text.split("\n"))  # lines go, none is changed
    gone = {i: text for i, text in before.items() if i not in by_id(steps[2])}
    first = {tuple(line_words(line)) for _, text in by_id(steps[2]).items() for line in text.split("\n")}
    for text in gone.values():
        for words in (tuple(line_words(line)) for line in text.split("\n")):
            near = any(words[:k] + words[k + 1 :] in first or len(words) >= 8 for k in range(len(words)))
            assert not words or words in first or near


def test_one_document_of_each_group_stays(steps):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    kept = {i: shingles(text) for i, text in by_id(steps[3]).items()}
    ids = sorted(kept)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            a, b = kept[i], kept[j]
            assert not a or not b or len(a & b) < 0.8 * len(a | b)
    before = {i: shingles(text) for i, text in by_id(steps[2]).items()}
    for i in set(before) - set(kept):
        assert any(len(before[i] & before[j]) >= 0.8 * len(before[i] | before[j]) for j in before if j != i)


def test_secrets_are_replaced_and_all_documents_stay(steps):
    before, after = by_id(steps[3]), by_id(steps[4])
    assert set(before) == set(after)
    changed = [i for i in before if before[i] != after[i]]
    assert changed and all(MARK in after[i] and candidates(before[i]) for i in changed)


def test_lengths_follow_the_texts(steps):
    for rows in steps[:-1]:
        assert all(r["n_chars"] == len(r["text"]) for r in rows)


def test_packing_holds_every_id_once(steps):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    pieces = {}
    for r in steps[5]:
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4")))
    for i, text in by_id(steps[4]).items():
        joined = np.concatenate([ids for _, ids in sorted(pieces.pop(i), key=lambda p: p[0])])
        assert joined.tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]
    assert not pieces


def test_run_is_all_stages_on_documents(spark):
    out = corpus_pipeline.run(spark, DATA).collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert {r["doc_id"] for r in out} < docs
    placed = sorted((r["sequence_id"], r["offset"], r["length"]) for r in out)
    at = 0
    for sequence, offset, length in placed:  # sequences without a gap, all but the last one full
        assert sequence * 2048 + offset == at
        at += length


def test_edges_go_through_all_stages(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, text_hash int, found int"
    rows = [(1, None), (2, ""), (3, " \n "), (None, "some words " * 30), (None, None), (4, "x y " * 20_000), (5, "a b c d e f " * 9)]
    rows = [(i, t, "en", None, len(t or ""), "r", 1, 2) for i, t in [*rows, rows[-1]]]
    docs = spark.createDataFrame(rows, schema)
    for start in (docs, docs.limit(0)):
        frame = start
        for name, stage in corpus_pipeline.STAGES:
            if name == "quality":  # all pass, so that the others see them
                model = quality.fit(frame, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"), grade())
                out = quality.selected(frame, model)
            else:
                out = stage(spark, frame, DATA)
            assert name == "packing" or out.columns == docs.columns
            frame = stored(out, name)  # as between the stages of a run
            assert (frame.count() == 0) == (start is not docs)


@pytest.mark.parametrize("before, after", [("10000", "1000"), ("0", "1000"), ("64", "64")])
def test_texts_go_to_python_in_short_batches(spark, before, after):
    """A batch of 10,000 texts, one for each task, did not fit beside the rest of an executor."""
    setting = spark.conf.get(corpus_pipeline.BATCH_SETTING)
    try:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, before)
        docs = spark.read.parquet(f"{DATA}/documents.parquet")
        corpus_pipeline.secret_stage(spark, docs, DATA)
        assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == after
    finally:
        spark.conf.set(corpus_pipeline.BATCH_SETTING, setting)


def test_a_worker_keeps_what_one_operator_remembers():
    """Words that packing remembers stayed in the workers that later compare near copies."""
    tokenizer = frames.remembered(WordTokenizer, tokenizer_path())
    assert frames.remembered(WordTokenizer, tokenizer_path()) is tokenizer
    gone = weakref.ref(tokenizer)
    del tokenizer
    shingles("some words of a text that is long enough")
    gc.collect()
    assert gone() is None and len(frames._remembered) == 1


class Direct:
    """Stands for a frame whose tasks the test runs itself."""

    def mapInArrow(self, run, schema):
        return run


def test_a_task_gives_back_what_it_freed(monkeypatch):
    """Memory that tasks freed stayed with the workers, beside what later stages need."""
    parts = [np.ones(250) for _ in range(40_000)]
    last = parts.pop()  # the heap does not end where the freed part begins
    del parts
    freed = _private_mb()
    batch = pa.RecordBatch.from_pydict({"text": ["a text"]})
    run = frames.map_slices(Direct(), lambda batch: {"n": [len(batch)]}, "n bigint")
    assert [b.to_pydict() for b in run(iter([batch]))] == [{"n": [1]}]
    assert _private_mb() < freed - 40 and len(last) == 250


def _private_mb():
    with open("/proc/self/smaps_rollup") as lines:
        return sum(int(line.split()[1]) for line in lines if line.startswith("Private_Dirty")) / 1024
