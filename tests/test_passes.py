"""Large tables are stored in passes: same rows, and one pass's shuffle files at a time."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from talentlake.operators import matching, scoring
from talentlake.operators.cascade import Cascade
from talentlake.operators.nearest import store_nearest
from talentlake.workspace import BYTES_PER_PASS, MOST_PASSES, in_pass, passes_over, stored
from test_cascade import by_type, literal_types, random_case, sides

PASSES = 3


def tables(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).glob("talentlake/*/*"))


def rows(table):
    return Counter(map(str, table.collect()))


@pytest.mark.parametrize("seed, block_limit", [(4, 2)])
def test_same_rows_in_passes(spark, seed, block_limit):
    roster, values = random_case(seed)
    roster = [*roster, (None, "jo ba", "t1"), (None, None, "t2"), (99, None, "t1")]
    both = sides(spark, roster, values)
    whole = Cascade(*both, block_limit=block_limit)
    expected = literal_types(roster, values)
    with Cascade(*both, block_limit=block_limit, passes=PASSES) as linked:
        assert by_type(linked.rows()) == expected
        for found in ("rows_keep_unmatched", "level_counts", "match_type_stats", "match_rate", "top_value"):
            assert rows(getattr(linked, found)()) == rows(getattr(whole, found)()), found
        for rank in (scoring.top_of_cascade, lambda c: scoring.best_per_player(c, "20240101")):
            assert rows(rank(linked)) == rows(rank(whole))


def test_best_candidates_in_passes(spark):
    roster, values = random_case(2)
    roster, values = sides(spark, [*roster, (5, None, "t1")], values)
    names = roster.where("name_normalized is not null").select("name_normalized").distinct()
    listed = matching.listed_names(values)
    nearest = store_nearest(names, listed)
    assert rows(store_nearest(names, listed, passes=PASSES)) == rows(nearest)
    best = matching.best_candidates(roster, nearest)
    assert best.count() > 0
    in_passes = matching.store_best_candidates(roster, nearest, PASSES)
    assert rows(in_passes.select(best.columns)) == rows(best)


def test_unmatched_players_are_stored_before_the_output(spark):
    """Before, the whole roster was grouped, and joined again, beside the shuffles of the output."""
    roster, values = random_case(1)
    before = tables(spark)
    with Cascade(*sides(spark, roster, values)) as linked:
        linked.settle()
        found = linked.rows_keep_unmatched()
        assert sorted(path.name for path in tables(spark) - before) == ["decisions", "near", "unmatched"]
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan and "LeftAnti" not in plan
        assert found.where("match_type = 'no_match'").count() > 0


def test_passes_follow_the_size(spark):
    few = stored(spark.range(10).withColumn("name", F.lit("jo")), "few")
    unknown = spark.createDataFrame([(1, "a")], "id long, name string")
    assert passes_over(few, unknown) == 1
    size = int(str(few._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    many = few.crossJoin(spark.range(BYTES_PER_PASS // size * 3).withColumnRenamed("id", "n"))
    assert 1 < passes_over(few, many) <= MOST_PASSES
    parts = [in_pass(spark.range(100), n, PASSES, "id").count() for n in range(PASSES)]
    assert sum(parts) == 100 and all(parts)
