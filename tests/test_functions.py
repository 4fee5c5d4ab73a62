import unicodedata

import pytest
from pyspark.sql import functions as F

from talentlake.functions import days, money, text
from talentlake.plans import inputs


def column(spark, values, expression, type_name="string"):
    """The expression's value for each of the values, in order."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {type_name}")
    return [r.y for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


NAMES = {
    "  Kylian  MBAPPÉ ": "kylian mbappe",
    "K. Mbappé-Lottin": "k mbappe lottin",
    "N'Golo Kanté": "n golo kante",
    "Ødegaard": "ødegaard",
    "\tÀÇÑŸ\n": "acny",
    "": "",
    None: None,
}


def test_normalize_name(spark):
    assert column(spark, NAMES, text.normalize_name) == list(NAMES.values())


def test_normalize_name_is_idempotent(spark):
    again = column(spark, NAMES, lambda c: text.normalize_name(text.normalize_name(c)))
    assert again == list(NAMES.values())


def test_name_keys(spark):
    names = ["kylian mbappe", "neymar jr", "pele", "", None]
    assert column(spark, names, text.last_name) == ["mbappe", "jr", "pele", "", None]
    assert column(spark, names, text.given_part) == ["kylian ", "neymar ", "", "", None]
    assert column(spark, names, text.first_initial) == ["k", "n", "p", "", None]


def test_fold_accents_keeps_other_letters(spark):
    assert column(spark, ["àéîõüÿñç œßšÉ’"], text.fold_accents) == ["aeiouync œßšÉ’"]


def test_full_name_skips_null(spark):
    full = lambda c: text.full_name(F.lit("Jo"), c)
    assert column(spark, ["Ba", None], full) == ["Jo Ba", "Jo"]


MONEY = {
    "33,59 mio. €": 33590000.0,
    " 7 M. ": 7000000.0,
    "12 mio k": 12000000.0,
    "k. A.": None,
    "unknown": None,
    "mio": None,
    "1,20 mrd. €": 1.2,
    "900 mille €": 900.0,
    "€60m": 60000000.0,
    "60 m": 60000000.0,
    "60m€": 60000000.0,
    "500 K €": 500000.0,
    "1 234 k €": 1000.0,
    "-": 0.0,
    "": 0.0,
    None: 0.0,
    "1.200,50 €": 1.2,
    "25 mln": 25.0,
}


def test_market_value(spark):
    assert column(spark, MONEY, money.market_value_eur) == pytest.approx(list(MONEY.values()))


GRAMMAR = {
    "33,59 mio. €": 33590000.0,
    " 7 M. ": 7000000.0,
    "12 mio k": 12000000.0,
    "k. A.": None,
    "mio": None,
    "1,20 mrd. €": 1.2e9,
    "900 mille €": 900000.0,
    "€60m": 60000000.0,
    "60m€": 60000000.0,
    "500 K €": 500000.0,
    "1 234 k €": 1234000.0,
    "-": None,
    "": None,
    None: None,
    "1.200,50 €": 1200.5,
    "1,234,567.89": 1234567.89,
    "25 mln": 25000000.0,
    "1.200": 1200.0,
    "1.20": 1.2,
    "CHF 1'234": 1234.0,
    "1.234 mln": 1234000.0,
    "1\u00a0234 €": 1234.0,
    "2.5bn": 2.5e9,
    "1234567": 1234567.0,
    "3 Million": 3000000.0,
    "5 apples": 5.0,
    "1 € of 2 mio": 1.0,
    "2 Mio. 3": 2000000.0,
}


def test_market_value_by_grammar(spark):
    found = column(spark, GRAMMAR, money.market_value_by_grammar)
    assert found == pytest.approx(list(GRAMMAR.values()))


def test_both_spellings_of_accents_compose(spark):
    letters = "".join(chr(c) for c in range(0xC0, text.LAST_LATIN + 1)) + " plain ø"
    apart = unicodedata.normalize("NFD", letters)
    assert apart != letters
    assert column(spark, [apart, letters, "", None], text.compose_accents) == [letters, letters, "", None]
    names = [*NAMES, "Zoë ǖ Škoda"]
    apart = [n and unicodedata.normalize("NFD", n) for n in names]
    composed = column(spark, apart, lambda c: text.normalize_name(c, compose=True))
    assert composed == column(spark, names, text.normalize_name)
    assert column(spark, apart, text.normalize_name) != composed


def test_first_number(spark):
    assert column(spark, ["a 3,5 4", "7.25m", "-", None], money.first_number) == [3.5, 7.25, None, None]


def test_days(spark):
    assert column(spark, ["20240131", None], days.iso_day)[0] == "2024-01-31"
    run_day = lambda c: days.default_run_day(c.cast("date"))
    assert column(spark, ["2024-03-01", "2025-01-01"], run_day) == ["20240229", "20241231"]


def test_marks_that_a_text_lacks_cost_one_look(spark):
    """Letters are searched only for the marks found; before, every text with a mark was searched for all."""
    rows = spark.createDataFrame([("u\u0308\u0304 a\u030a e\u0301\u0302 x\u0301",)], "x string")
    composed = rows.select(text.compose_accents(F.col("x")).alias("y"))
    assert composed.first().y == "\u01d6 \u00e5 \u00e9\u0302 x\u0301"
    plan = composed._jdf.queryExecution().analyzed().toString()
    assert plan.index("Contains") < plan.index("replace(")


def test_only_texts_with_accents_are_taken_apart(spark):
    rows = spark.createDataFrame([(letters,) for letters in (text.FOLD_FROM, "plain", "", None)], "x string")
    apart = rows.select(inputs.decomposed(F.col("x")).alias("y"))
    assert [r.y for r in apart.collect()] == [unicodedata.normalize("NFD", text.FOLD_FROM), "plain", "", None]
    assert "RLIKE" in apart._jdf.queryExecution().analyzed().toString()


def test_plain_names_are_not_translated(spark):
    """The form before, which translated every letter, gives the same names."""
    odd = ["", " ", "A-b.c'd", "--", "\u00c9l\u00e9 \u00d1o-\u00fc", "\u00a0a\u00a0", "a\t\n\u000bb", "\u0130x", "e\u0301-f", "\U0001f600.-x", None]
    names = spark.createDataFrame([(x,) for x in odd], "x string")
    all_letters = F.translate(F.lower(F.trim("x")), text.FOLD_FROM + text.BREAKS, text.FOLD_TO + " " * len(text.BREAKS))
    both = names.select(text.normalize_name(F.col("x")).alias("y"), F.trim(F.regexp_replace(all_letters, r"\s+", " ")).alias("z"))
    assert both.where("not y <=> z").collect() == []
    assert "octet_length" in names.select(text.normalize_name(F.col("x")))._jdf.queryExecution().analyzed().toString()
