"""Corpus pipeline: quality, line dedup, near-duplicates, secrets, packing.

Each stage takes the documents that the one before it kept and returns those that it keeps, with
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from talentlake.llm import jaccard, line_dedup, packing, quality, secrets
from talentlake.llm.frames import table
from talentlake.llm.queries import grade, tokenizer_path
from talentlake.workspace import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows of texts that go to Python at once. Of the default, 10,000, a batch alone is tens of
# megabytes for each task, on both sides.
BATCH_ROWS = 1000


def in_short_batches(stage: Stage) -> Stage:
    """A stage whose session hands Python at most ``BATCH_ROWS`` rows at once. The setting stays,
    since a stage's rows are made when its result is written."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if not 0 < int(spark.conf.get(BATCH_SETTING)) <= BATCH_ROWS:
            spark.conf.set(BATCH_SETTING, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


@in_short_batches
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.selected(docs, quality.fit(docs, table(spark, sf_dir, "labels"), grade()))


@in_short_batches
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line nearly equals go, and documents that this empties."""
    return line_dedup.without_repeats(docs, size="n_chars")


@in_short_batches
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard.first_of_groups(docs)


@in_short_batches
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced; all documents stay."""
    return secrets.redact(docs, size="n_chars")


@in_short_batches
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("packing", packing_stage),
]

# A trained classifier and a tokenizer are not SQL; tests/llm hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
