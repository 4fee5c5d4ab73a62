"""Every route of the nearest-name search against comparing all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from reference_cascade import distance, last_name, value_order
from talentlake.functions import text
from talentlake.operators import nearest
from talentlake.operators.matching import listed_names, with_name_keys
from talentlake.operators.nearest import BLANK, edit_patterns, nearest_names

ROUTES = {
    "blocks": {},
    "blocks in slices": {"slice_names": 3},
    "patterns and segments": {"block_limit": 0},
    "mostly segments": {"block_limit": 0, "pattern_length": 3},
    "segments": {"block_limit": 0, "pattern_length": -1},
    "mixed": {"block_limit": 25, "slice_names": 5, "pattern_length": 6},
}


def random_names(seed, n, last_names):
    rng = random.Random(seed)
    names = set()
    while len(names) < n:
        given = "".join(rng.choice("abé ") for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 14, 20])))
        # One last name takes most of the names.
        last = last_names[0] if rng.random() < 0.6 else rng.choice(last_names)
        names.add(" ".join(f"{given} {last}".split()))
    return sorted(names)


def mutated(seed, names):
    """Near copies, since random long names are never within three edits."""
    rng = random.Random(seed)
    out = set()
    for name in names:
        chars = list(name)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(max(1, len(chars) - 3))
            chars[i : i + rng.randrange(2)] = rng.choice(["", "a", "x"])
        out.add(" ".join("".join(chars).split()))
    return sorted(out)


@pytest.fixture(scope="module")
def case(spark):
    names = random_names(1, 90, ["lo", "ba", "quentin"])
    targets = sorted(set(random_names(2, 60, ["lo", "ba", "zé"])) | set(mutated(3, names)))
    rng = random.Random(4)
    values = [(t, rng.choice([None, 1.0, 2.0]), rng.choice([None, "a", "b"])) for t in targets for _ in "12"]
    left = spark.createDataFrame([(n,) for n in names], "name_normalized string")
    right = spark.createDataFrame(values, "player_name string, market_value_eur double, market_value_raw string")
    listed = listed_names(with_name_keys(right, "player_name"))
    # with_name_keys folds the accents, so the plain names must be folded for comparison.
    folded = [(t.replace("é", "e"), eur, raw) for t, eur, raw in values]
    return names, left, folded, listed


def expected(names, values):
    out = {}
    for name in names:
        block = [v for v in values if last_name(v[0]) == last_name(name)]
        if not block:
            out[name] = (None, None, None, None)
            continue
        best = min(block, key=lambda v: (distance(name, v[0]), v[0], value_order(*v[1:])))
        d, (target, eur, raw) = distance(name, best[0]), best
        out[name] = (d, target, eur, raw) if d <= 3 else (4, None, None, None)
    return out


@pytest.mark.parametrize("route", ROUTES)
def test_same_winner_as_all_pairs(case, route):
    names, left, values, listed = case
    found = {r[0]: tuple(r)[1:] for r in nearest_names(left, listed, **ROUTES[route]).collect()}
    assert found == expected(names, values)


def test_edit_patterns(spark):
    patterns = spark.range(1).select(edit_patterns(F.lit("ab"), 1)).first()[0]
    assert sorted(patterns) == sorted(["ab", "b", "a", BLANK + "b", "a" + BLANK])
    assert spark.range(1).select(edit_patterns(F.lit(""))).first()[0] == [""]


def test_signatures_are_never_broadcast(spark, case):
    """Of hundreds a name, while their size is guessed from the names'."""
    _, left, _, listed = case
    name = F.col("name_normalized")
    probes = left.select(name, text.last_name(name).alias("last_name"), text.given_part(name).alias("given"))
    targets = listed.select("last_name", text.given_part(F.col("v_name")).alias("v_given"), "v_name", "value")
    for found, key in ((nearest._by_patterns(probes, targets, 10), "signature"), (nearest._by_segments(probes, targets, 10), "segment")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join [" in line and key in line]
        assert joins and all("SortMergeJoin" in line for line in joins)
