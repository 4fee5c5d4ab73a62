"""Unit-bearing money text to EUR."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first number in the text, and the short form of millions.
NUMBER = r"([0-9]+(?:[.,][0-9]+)?)"
SHORT_MILLIONS = r"\b[0-9]+(?:[.,][0-9]+)?\s*m\b"


def first_number(text: Column) -> Column:
    """First number in the text as double, a decimal comma allowed; NULL without digits."""
    # try_cast, because ANSI mode raises on the empty string of a text without digits.
    return F.replace(F.regexp_extract(text, NUMBER, 1), F.lit(","), F.lit(".")).try_cast("double")


def market_value_eur(raw: Column) -> Column:
    """EUR amount of a market-value text.

    The first unit that applies wins: 'mio', a number followed by 'm', 'k', none. A unit
    without digits gives NULL; neither unit nor digits (or a NULL text) gives 0.
    """
    text = F.lower(F.trim(raw))
    number = first_number(text)
    return (
        F.when(text.contains("mio") | text.rlike(SHORT_MILLIONS), number * 1000000.0)
        .when(text.contains("k"), number * 1000.0)
        .otherwise(F.coalesce(number, F.lit(0.0)))
    )


# Units of the wider grammar, by what they multiply with.
UNITS = {
    1e9: r"mrd|mld|bn|milliards?|milliarden?|billions?",
    1e6: r"mio|mln|m|millions?|millionen",
    1e3: r"k|tsd|mille|thousand",
}
# What may stand between groups of three digits beside a dot or a comma.
GROUP_BREAKS = " \u00a0\u202f'’"
GROUPED = rf"[0-9]{{1,3}}(?:[{GROUP_BREAKS}.,][0-9]{{3}})+(?![0-9])(?:[.,][0-9]+)?|[0-9]+(?:[.,][0-9]+)?"


def grouped_number(text: Column, decimal: Column) -> Column:
    """First number in the text as double, its digits perhaps in groups of three; NULL without one.

    Of two kinds of separators the last one is the decimal one; a kind that repeats separates
    groups. A single dot or comma before exactly three digits is a group's, unless ``decimal``.
    """
    found = F.translate(F.regexp_extract(text, GROUPED, 0), GROUP_BREAKS, "")
    last = F.regexp_extract(found, "([.,])[0-9]*$", 1)
    digits_after = F.length(F.regexp_extract(found, "[.,]([0-9]*)$", 1))
    occurs = F.length(found) - F.length(F.replace(found, last, F.lit("")))
    two_kinds = found.contains(".") & found.contains(",")
    is_decimal = (last != "") & (two_kinds | ((occurs == 1) & ((digits_after != 3) | decimal)))
    whole = F.regexp_replace(F.regexp_extract(found, "^(.*)[.,]", 1), "[.,]", "")
    fraction = F.regexp_extract(found, "[.,]([0-9]*)$", 1)
    plain = F.when(is_decimal, F.concat(whole, F.lit("."), fraction)).otherwise(F.regexp_replace(found, "[.,]", ""))
    return plain.try_cast("double")


def market_value_by_grammar(raw: Column) -> Column:
    """EUR amount of a market-value text by the wider grammar, for feeds that need it.

    It knows thousands to billions in the words of several languages, and digits in groups. A
    unit counts where it follows the number. Text without a number gives NULL.
    """
    text = F.lower(F.trim(raw))
    after = F.regexp_extract(text, rf"^[^0-9]*(?:{GROUPED})\s*(\p{{L}}*)", 1)
    factor = F.lit(1.0)
    for value, names in reversed(UNITS.items()):
        factor = F.when(after.rlike(f"^(?:{names})$"), F.lit(value)).otherwise(factor)
    return grouped_number(text, factor >= 1e6) * factor
