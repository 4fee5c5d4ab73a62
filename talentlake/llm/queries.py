"""The registered query of each operator, over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake.llm import licences, personal, quality, segmentations, toxicity
from talentlake.llm.collisions import near_duplicates
from talentlake.llm.collocations import collocations
from talentlake.llm.frames import same, table, text_hash
from talentlake.llm.jaccard import jaccard_join
from talentlake.llm.labelled import fold
from talentlake.llm.line_dedup import repeated_lines
from talentlake.llm.line_frequency import line_frequency
from talentlake.llm.packing import pack
from talentlake.llm.secrets import KINDS, secrets
from talentlake.llm.spelling import variants


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    removed = repeated_lines(docs)
    keys = docs.select("doc_id", text_hash().alias("text_hash"))
    return keys.join(removed, same(keys, removed, "doc_id", "text_hash"), "left").select(
        keys["doc_id"],
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce(F.array_join(F.transform("removed", lambda k: k.cast("string")), ","), F.lit("")).alias("removed_lines"),
    )


def op2_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_licence_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licences.licences(docs, licences.fit(docs))
    return found.select(
        "doc_id",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.col("notices.family"))), ",").alias("families"),
        F.array_join(
            F.transform("notices", lambda x: F.concat_ws(":", x["paragraph"].cast("string"), x["family"])), ","
        ).alias("paragraphs"),
    )


def op4_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    held_out = F.col("doc_id").isNotNull() & (fold() == 0)
    return toxicity.toxicity(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_concatenate_and_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_frequency(table(spark, sf_dir, "documents"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *base, "base_failed", "kept", "removed_words", "removed_lines")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("text_hash")


def grade() -> Column:
    """Rating of a labelled row: 0 low quality, 1 toxic, 2 neither."""
    return F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), grade())
    return quality.quality(docs.select("doc_id", "text"), model).drop("text")


def op9_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = segmentations.encode(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return samples.select(
        "doc_id",
        "sample",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        "log_prob",
        "log_inclusion",
    )


def op10_ownership_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(KINDS[:3]))
    live = F.filter("spans", lambda s: s["live"])
    return secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(count, KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        joined(live).alias("live_spans"),
    )


def op11_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_gram_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, personal.KINDS))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{personal.KINDS[kind]}")

    base = F.filter("spans", lambda s: s["kind"] != personal.CONTEXT)
    return personal.personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *map(count, range(personal.CONTEXT)),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        count(personal.CONTEXT),
    )


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_collision_counting": op2_collision_counting,
    "op3_licence_classifier": op3_licence_classifier,
    "op4_kneser_ney": op4_kneser_ney,
    "op5_concatenate_and_cut": op5_concatenate_and_cut,
    "op6_line_frequency": op6_line_frequency,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_gumbel_segmentations": op9_gumbel_segmentations,
    "op10_ownership_frequency": op10_ownership_frequency,
    "op11_trie_collocations": op11_trie_collocations,
    "op12_gram_spelling": op12_gram_spelling,
    "op13_bootstrapped_pii": op13_bootstrapped_pii,
}
