"""Name text: normalization, accent folding and the matching keys cut from a name."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that fold, and the letter each one becomes.
FOLD_FROM = "àáâãäåèéêëìíîïòóôõöùúûüýÿñç"
FOLD_TO = "aaaaaaeeeeiiiiooooouuuuyync"
# Punctuation that counts as a word break inside a name.
BREAKS = ".-'"


def fold_accents(text: Column) -> Column:
    """Replace the accented lower-case letters above; every other character stays."""
    return F.translate(text, FOLD_FROM, FOLD_TO)


# Latin letters that can be written as a letter and a combining mark, those with one mark first,
# so that a letter with two marks is composed one mark after the other.
LAST_LATIN = 0x24F
COMBINING = "[\u0300-\u036f]"


def _compositions() -> list[tuple[str, str]]:
    letters = sorted(map(chr, range(0xC0, LAST_LATIN + 1)), key=lambda c: len(unicodedata.normalize("NFD", c)))
    parts = {letter: unicodedata.decomposition(letter).split() for letter in letters}
    return [
        ("".join(chr(int(code, 16)) for code in codes), letter)
        for letter, codes in parts.items()
        if len(codes) == 2 and not codes[0].startswith("<")
    ]


def compose_accents(text: Column) -> Column:
    """Latin letters followed by combining marks as single letters. Text without marks, nearly
    all text, is only looked at, and other text is searched for the letters of the marks it has.
    Letters with equally many marks never overlap, so their order among each other is free."""
    by_mark: dict[tuple[int, str], list[Column]] = {}
    for apart, letter in _compositions():
        pair = F.struct(F.lit(apart).alias("apart"), F.lit(letter).alias("one"))
        by_mark.setdefault((len(unicodedata.normalize("NFD", letter)), apart[-1]), []).append(pair)
    steps = F.array(
        *[F.struct(F.lit(mark).alias("mark"), F.array(*pairs).alias("pairs")) for (_, mark), pairs in by_mark.items()]
    )

    def with_mark(t: Column, step: Column) -> Column:
        joined = F.aggregate(step["pairs"], t, lambda u, pair: F.replace(u, pair["apart"], pair["one"]))
        return F.when(F.contains(t, step["mark"]), joined).otherwise(t)

    return F.when(text.rlike(COMBINING), F.aggregate(steps, text, with_mark)).otherwise(text)


def normalize_name(name: Column, compose: bool = False) -> Column:
    """Lower case, fold accents, break on punctuation, collapse white space. With ``compose``,
    letters with combining marks become single letters first, so that both spellings fold alike."""
    if compose:
        name = compose_accents(name)
    letters = F.lower(F.trim(name))
    # Only letters of more than a byte fold; most names have none and need no translating.
    folded = F.when(F.octet_length(letters) > F.length(letters), fold_accents(letters)).otherwise(letters)
    # Breaks and white space are disjoint from what folds, so one pass does both.
    return F.trim(F.regexp_replace(folded, f"[\\s{re.escape(BREAKS)}]+", " "))


def last_name(normalized: Column) -> Column:
    """The last space-separated token ('' for an empty name)."""
    return F.substring_index(normalized, " ", -1)


def given_part(normalized: Column) -> Column:
    """What precedes the last token, its separating space included."""
    return F.left(normalized, F.length(normalized) - F.length(last_name(normalized)))


def first_initial(normalized: Column) -> Column:
    return F.substring(normalized, 1, 1)


def full_name(*parts: Column) -> Column:
    """Name parts joined by a space, NULL parts skipped."""
    return F.concat_ws(" ", *parts)


def edit_distance(left: Column, right: Column, at_most: int | None = None) -> Column:
    """Levenshtein distance; with ``at_most`` it is -1 beyond that bound and cheaper."""
    return F.levenshtein(left, right, at_most)
