"""The cascade against its row-by-row form, and its corner cases by hand."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reference_cascade import Listing, Value, cascade as literal
from talentlake.operators import matching, scoring
from talentlake.operators.cascade import Cascade
from talentlake.sources import search_documents
from talentlake.workspace import stored

ROSTER = "player_id bigint, player_name_api string, team_name string, league_name string, extraction_date string"
VALUES = "player_name string, market_value_eur double, market_value_raw string"
OUT = ["player_id", "player_name_api", "team_name", "market_value_eur", "market_value_raw"]


def sides(spark, roster, values):
    left = spark.createDataFrame([(i, n, t, "l", "d") for i, n, t in roster], ROSTER)
    right = spark.createDataFrame(values, VALUES)
    return (
        matching.with_name_keys(left, "player_name_api"),
        matching.with_name_keys(right, "player_name"),
    )


def by_type(rows):
    out = {}
    for r in rows.collect():
        out.setdefault(r.match_type, Counter())[tuple(r[c] for c in OUT)] += 1
    return out


def literal_types(roster, values):
    """All names here are already normalized."""
    found = literal([Listing(i, n, t, n) for i, n, t in roster], [Value(n, e, r) for n, e, r in values])
    labels = ["exact", "lastname_initial", "fuzzy", "no_match"]
    return {label: Counter(rows) for label, rows in zip(labels, found) if rows}


def random_case(seed):
    rng = random.Random(seed)
    given = ["jo", "joe", "jon", "jonas", "a", "al", "alf", "maria", "marie", "x y", "maximilian"]
    last = ["ba", "ba", "ba", "li", "ki", "no"]

    def name(missing):
        if rng.random() < missing:
            return None
        return " ".join(filter(None, [rng.choice(given + [""]), rng.choice(last)]))

    # One name holds a third of either side.
    roster = [
        (rng.randrange(40), "jo ba" if rng.random() < 0.3 else name(0.05), rng.choice(["t1", "t2", "t3"]))
        for _ in range(90)
    ]
    values = [
        (
            "jo ba" if rng.random() < 0.3 else name(0.1),
            rng.choice([None, None, None, 0.0, 1.0, 2.0, 5.5]),
            rng.choice([None, "a", "b"]),
        )
        for _ in range(25)
    ]
    return roster, values


@pytest.mark.parametrize("seed, block_limit", [(1, 1024), (2, 1024), (3, 0), (4, 2)])
def test_against_literal_form(spark, seed, block_limit):
    roster, values = random_case(seed)
    linked = Cascade(*sides(spark, roster, values), block_limit=block_limit)
    expected = literal_types(roster, values)
    assert by_type(linked.rows()) == expected

    total = {label: sum(rows.values()) for label, rows in expected.items()}
    assert {r["match_type"]: r["count"] for r in linked.match_type_stats().collect()} == total
    counts = linked.level_counts().first()
    assert counts.roster_rows == len(roster) and counts.values_rows == len(values)
    assert counts.output_rows == sum(total.values())

    valued = [r for rows in expected.values() for r in rows.elements() if r[3] > 0]
    rate = linked.match_rate().first()
    assert rate.matched_rows == len(valued)
    assert rate.matched_players == len({r[0] for r in valued})
    assert rate.input_players == len({r[0] for r in roster})
    values_out = [r[3] for rows in expected.values() for r in rows.elements()]
    assert linked.top_value().first().top_value == max(values_out, default=1.0)


@pytest.mark.parametrize("seed", [1, 5])
def test_keep_unmatched_covers_every_player(spark, seed):
    roster, values = random_case(seed)
    expected = literal_types(roster, values)
    expected.pop("no_match", None)
    emitted = {r[0] for rows in expected.values() for r in rows}
    rest = Counter()
    for player in {r[0] for r in roster} - emitted:
        listings = [(t, n is not None, n or "") for i, n, t in roster if i == player]
        team, known, name = min(listings)
        rest[(player, name if known else None, team, 0.0, "0")] += 1
    expected["no_match"] = rest
    assert by_type(Cascade(*sides(spark, roster, values)).rows_keep_unmatched()) == expected


def types(spark, roster, values):
    return {
        (r.player_id, r.match_type, r.market_value_eur): n
        for r, n in Counter(
            Cascade(*sides(spark, roster, values))
            .rows()
            .select("player_id", "match_type", "market_value_eur")
            .collect()
        ).items()
    }


def test_equal_names_fan_out(spark):
    found = types(spark, [(1, "Jo Ba", "t")], [("jo ba", 1.0, "1"), ("JO BÀ", 2.0, "2")])
    assert found == {(1, "exact", 1.0): 1, (1, "exact", 2.0): 1}


def test_null_value_is_no_match_and_goes_on(spark):
    # The NULL row goes on beside the exact match: at level two it meets both valued names
    # and itself, and by way of itself it reaches level three.
    values = [("jo ba", 1.0, "1"), ("jo ba", None, None), ("jim ba", 2.0, "2")]
    assert types(spark, [(1, "jo ba", "t")], values) == {
        (1, "exact", 1.0): 1,
        (1, "lastname_initial", 1.0): 1,
        (1, "lastname_initial", 2.0): 1,
        (1, "fuzzy", 1.0): 1,
    }


def test_null_values_multiply_the_residual(spark):
    values = [("jo ba", None, None), ("jo ba", None, None), ("jim ba", 2.0, "2")]
    assert types(spark, [(1, "jo ba", "t")], values) == {
        (1, "lastname_initial", 2.0): 2,
        (1, "no_match", 0.0): 1,
    }


def test_many_copies_come_out_in_steps(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 10), ("c", 11), ("d", 25)], "x string, n bigint")
    assert Counter(r.x for r in matching._repeated(rows, "n", step=10).collect()) == {
        "a": 1,
        "b": 10,
        "c": 11,
        "d": 25,
    }


def test_nearest_without_value_is_no_match(spark):
    assert types(spark, [(1, "xo ba", "t")], [("jo ba", None, None)]) == {(1, "no_match", 0.0): 1}


def test_two_teams_reach_level_three_as_one_row(spark):
    found = types(spark, [(1, "xo ba", "t1"), (1, "xo ba", "t2")], [("jo ba", 1.0, "1")])
    assert found == {(1, "fuzzy", 1.0): 1}


def test_three_edits_match_and_four_do_not(spark):
    roster = [(1, "xxx ba", "t"), (2, "xxxx ba", "t")]
    assert types(spark, roster, [("jon ba", 1.0, "1")]) == {(1, "fuzzy", 1.0): 1}


def test_no_shared_last_name_is_dropped_or_kept(spark):
    data = sides(spark, [(1, "jo ba", "t")], [("jo li", 1.0, "1")])
    assert Cascade(*data).rows().collect() == []
    kept = Cascade(*data).rows_keep_unmatched().select("player_id", "match_type").collect()
    assert kept == [(1, "no_match")]


def test_name_without_block_drops_its_player(spark):
    # The second listing has nothing to be compared with; its NULL distance sorts first.
    roster = [(1, "xo ba", "t1"), (1, "xo unknown", "t2")]
    assert types(spark, roster, [("jo ba", 1.0, "1")]) == {}


def test_ties_go_to_the_first_name_then_the_highest_value(spark):
    values = [("jb ba", 9.0, "9"), ("ja ba", 1.0, "1"), ("ja ba", 2.0, "2"), ("ja ba", None, None)]
    assert types(spark, [(1, "xa ba", "t")], values) == {(1, "fuzzy", 2.0): 1}


def test_empty_names_match_each_other(spark):
    assert types(spark, [(1, "", "t")], [("", 1.0, "1")]) == {(1, "exact", 1.0): 1}


@pytest.mark.parametrize("roster, values", [([], [("a", 1.0, "1")]), ([(1, "a", "t")], []), ([], [])])
def test_empty_sides(spark, roster, values):
    linked = Cascade(*sides(spark, roster, values))
    assert linked.rows().collect() == []
    assert linked.match_type_stats().collect() == []
    assert linked.top_value().first().top_value == 1.0
    assert linked.match_rate().first().match_rate == 0.0
    assert scoring.score(linked, "20240101").collect() == []


def test_value_index(spark):
    rows = spark.createDataFrame([(1, 50.0), (2, 200.0), (3, 0.0), (4, None)], "i int, market_value_eur double")
    top = rows.agg(F.max("market_value_eur").alias("top_value"))
    index = {r.i: r.value_index for r in scoring.with_value_index(rows, top).collect()}
    assert index == {1: 25.0, 2: 100.0, 3: 0.0, 4: 0.0}


def test_value_index_of_zeros(spark):
    rows = spark.createDataFrame([(1, 0.0)], "i int, market_value_eur double")
    top = rows.agg(F.max("market_value_eur").alias("top_value"))
    assert scoring.with_value_index(rows, top).first().value_index == 0.0


def test_top_players(spark):
    roster = [(i, f"p{i} last{i}", "t") for i in range(15)]
    values = [(f"p{i} last{i}", float(i), "x") for i in range(15)]
    final = scoring.score(Cascade(*sides(spark, roster, values)), "20240101")
    top = scoring.top_players(final).collect()
    assert [r.player_id for r in top] == list(range(14, 4, -1))
    assert top[0].value_index == 100.0


@pytest.mark.parametrize("seed", [1, 2, 7, 8])
def test_top_of_cascade_is_that_of_all_rows(spark, seed):
    roster, values = random_case(seed)
    roster, values = roster + roster[:5], values * 3
    linked = Cascade(*sides(spark, roster, values))
    rows = linked.rows().count()
    expected = scoring.top_players(scoring.score(linked, "20240101"), 10).collect()
    assert scoring.top_of_cascade(linked, 10).collect() == expected
    assert scoring.top_of_cascade(linked, 10_000).count() == rows


def test_top_of_cascade_expands_few_rows(spark):
    """Three hundred listings of one name and as many values of it are 90,000 rows; ten roster
    rows and ten values of each are enough."""
    roster = [(i, "jo ba", f"t{i}") for i in range(300)] + [(900, "al li", "t")]
    values = [("jo ba", float(i % 7), str(i)) for i in range(300)] + [("al li", None, None)] * 50 + [("ad li", 9.0, "9")]
    linked = Cascade(*sides(spark, roster, values))
    linked.settle()
    best = scoring.with_value_index(linked.best_rows(), linked.top_value())
    assert best.count() == 302  # the roster's rows, and level three's winner
    chosen = stored(best.orderBy(*scoring.ranking()).limit(10).drop("value_index"), "chosen")
    expanded = linked.rows_of(chosen, 10)
    assert expanded.count() <= 9 * 10 + 10
    top = scoring.top_of_cascade(linked, 10).collect()
    # Al's fifty NULL values reach level two, so he alone has fifty rows of the highest value.
    assert [(r.player_id, r.value_index) for r in top] == [(900, 100.0)] * 10
    assert top == scoring.top_players(scoring.score(linked, "d"), 10).collect()


@pytest.mark.parametrize("seed", [1, 2, 9])
def test_published_rows_without_the_fan_out(spark, seed):
    roster, values = random_case(seed)
    linked = Cascade(*sides(spark, roster, values * 2))
    all_rows = scoring.score(linked, "20240101")
    expected = search_documents.one_per_id(all_rows)
    found = scoring.best_per_player(linked, "20240101")
    assert found.columns == all_rows.columns
    assert Counter(found.collect()) == Counter(expected.collect())


def test_single_levels_as_joins(spark):
    roster, values = random_case(6)
    left, right = sides(spark, roster, values)
    expected = literal_types(roster, values)
    one = matching.exact_match(left, right)
    two = matching.lastname_initial_match(matching.residual(one), right)
    assert by_type(matching.matched(one)) == {"exact": expected["exact"]}
    assert by_type(matching.matched(two)) == {"lastname_initial": expected["lastname_initial"]}


def test_union_fills_missing_columns(spark):
    one = spark.range(1).toDF("id")
    union = matching.cascade_union(one, one.withColumn("x", F.lit(7)))
    assert sorted(union.collect(), key=str) == [(0, 7), (0, None)]
