"""Quality rules by cross-document line frequency. DataFrame operations only.

Lines are normalised (lower case, digits as 0, white space as one space) and hashed; a line
that more than ``max_docs`` distinct documents of one host carry is boilerplate there and
counts as removed. A document that keeps fewer than ``min_words`` words, or less than
``min_share`` of its words, is depleted and rejected.

One narrow pass reads the texts and stores a few numbers per document and line; shuffles move
hashes only. Documents per line are counted in two steps, so a line that a third of all
documents carry is a number per task before it moves; the lines above the limit are stored
and joined back by plain shuffles, which adaptive execution can split.

Null or empty text: no words, base rule fails. Null host: a host of its own. Null id: rows
without id count as one document. Repeated rows are one document and get one row each. Very
long texts are handled in place. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import same
from talentlake.workspace import stored

SPACE = r"[\x20\x09-\x0D]+"
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = "#*$%&|<>"  # fixed values
MIN_WORDS = 50  # fixed value
MAX_REPEAT_PERCENT = 50  # fixed value
MAX_DOCS = 20
MIN_SHARE = 0.5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, characters: str | tuple[str, ...]) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character))
    return text


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.filter(F.split(text, SPACE), lambda word: word != "")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more, first ones included.

    Windows are compared by a 64-bit hash. Only a text with equal windows sorts them.
    """

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )

        def positions(s: Column) -> Column:
            def twice(x: Column, k: Column) -> Column:
                before, after = F.get(s, k - 1)["h"], F.get(s, k + 1)["h"]
                return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

            return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))

        def span(p: Column) -> Column:
            # A window adds three words, or what lies beyond the window before it.
            gaps = F.transform(p, lambda x, k: F.coalesce(F.least(x - F.get(p, k - 1), F.lit(3)), F.lit(3)))
            return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

        return _let(_let(placed, positions), span)

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        )

    def count(w: Column) -> Column:
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(
            _let(
                windows(w),
                lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
            )
        )

    return _let(words, count)


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(line), "123456789", "000000000"), SPACE, " "))


def _line_words(line: Column) -> Column:
    """Words of a normalised line: its spaces and one."""
    return F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: base numbers, and its distinct lines with the words they hold."""
    body = F.coalesce(F.col(text), F.lit(""))
    octets = F.octet_length(body)
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.btrim(line, F.lit("".join(SPACES)))) > 0)
    words = words_of(body)
    read = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(host).alias("host"),
        F.size(words).cast("long").alias("n_words"),
        F.length(_without(body, SPACES)).cast("long").alias("word_chars"),
        (octets - F.octet_length(_without(body, tuple(SYMBOLS)))).cast("long").alias("n_symbols"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
        lines.alias("raw"),
    )

    def entry(line: Column) -> Column:
        return F.struct(F.xxhash64(line).alias("line"), _line_words(line).alias("words"))

    return read.select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("raw") - F.size(F.array_distinct("raw"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.transform(F.transform("raw", normalised), entry).alias("lines"),
    )


def line_frequency(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    max_docs: int = MAX_DOCS,
    min_words: int = MIN_WORDS,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """One row per document: base numbers, ``base_failed``, the words and lines that are
    boilerplate of its host, ``depleted`` and ``kept``."""
    base = stored(measured(docs, doc_id, text, host).withColumn("row", F.monotonically_increasing_id()), "measured")
    frequent = stored(
        base.select("host", "doc_id", F.explode(F.array_distinct(F.col("lines.line"))).alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("docs"))
        .where(F.col("docs") > max_docs)
        .select("host", "line"),
        "frequent_lines",
    )
    carried = base.select("row", "host", F.inline("lines"))
    removed = (
        carried.join(frequent, same(carried, frequent, "host", "line"))
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"), F.count("*").alias("removed_lines"))
    )
    return (
        base.drop("lines")
        .join(removed, "row", "left")
        .drop("row")
        .fillna(0, ["removed_words", "removed_lines"])
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
        .withColumn("left_words", F.col("n_words") - F.col("removed_words"))
        .withColumn(
            "depleted",
            (F.col("removed_words") > 0)
            & ((F.col("left_words") < min_words) | (F.col("left_words") < min_share * F.col("n_words"))),
        )
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    )
