"""A third of the roster under one name: the joins that read stored tables must split it."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from talentlake.operators import matching
from talentlake.operators.cascade import Cascade
from talentlake.operators.nearest import nearest_names
from talentlake.plans.queries import QUERIES
from talentlake.workspace import CLEANUP, fresh_path, shared_folder, stored

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "30KB",
}


@pytest.fixture
def small_thresholds(spark):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def hot_name(exact, near):
    """A third of the rows each: one name, another one, and many."""
    i = F.col("id")
    return F.when(i % 3 == 0, exact).when(i % 3 == 1, near).otherwise(F.concat(F.lit("p l"), i % 5000))


def test_hot_names_are_split(spark, small_thresholds):
    roster = spark.range(ROWS).repartition(16).select(
        F.col("id").alias("player_id"),
        hot_name("jo hot", "xo hotter").alias("player_name_api"),
        F.concat(F.lit("t"), "id").alias("team_name"),
        F.lit("l").alias("league_name"),
        F.lit("d").alias("extraction_date"),
    )
    values = spark.range(3000).select(
        F.when(F.col("id") == 1, "jo hot")
        .when(F.col("id") == 2, "ja hotter")
        .otherwise(F.concat(F.lit("none l"), "id"))
        .alias("player_name"),
        F.lit(1.0).alias("market_value_eur"),
        F.lit("r").alias("market_value_raw"),
    )
    cascade = Cascade(
        stored(matching.with_name_keys(roster, "player_name_api"), "roster"),
        stored(matching.with_name_keys(values, "player_name"), "values"),
    )
    rows = cascade.rows()
    found = rows.groupBy("match_type").count()
    assert {r["match_type"]: r["count"] for r in found.collect()} == {"exact": ROWS // 3, "fuzzy": ROWS // 3}
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert final.count("SortMergeJoin(skew=true)") == 2
    assert "ReusedExchange" in final  # the roster is shuffled by name once


def test_a_hot_signature_is_split(spark, small_thresholds):
    """Three-letter given names are all one pattern of three blanks."""
    given = F.concat(*[F.char(F.lit(97) + F.floor(F.col("id") / step).cast("int") % 26) for step in (1, 26, 676)])
    names = stored(
        spark.range(17_000).select(F.concat(given, F.lit(" hot")).alias("name_normalized")).repartition(8), "names"
    )
    values = spark.range(300).select(
        F.concat(F.lit("0"), F.col("id").cast("string"), F.lit(" hot")).alias("player_name"),
        F.col("id").cast("double").alias("market_value_eur"),
        F.lit("r").alias("market_value_raw"),
    )
    listed = stored(matching.listed_names(matching.with_name_keys(values, "player_name")), "listed")
    near = nearest_names(names, listed, block_limit=100)
    rows = near.collect()
    assert len(rows) == 17_000 and {r.distance for r in rows} == {3} and {r.v_name for r in rows} == {"00 hot"}
    plan = near._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")]
    assert "SortMergeJoin(skew=true)" in final


def test_shared_folder_is_the_session_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    paths = {fresh_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith(folder) for p in paths)


def test_shared_folder_on_a_cluster_must_be_named():
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context

        def __init__(self, **settings):
            self.conf = {"spark.sql.warehouse.dir": "file:/home/warehouse", **settings}

    with pytest.raises(ValueError):
        shared_folder(Session())
    assert shared_folder(Session(**{"spark.sql.warehouse.dir": "hdfs://n/warehouse"})) == "hdfs://n/warehouse/_work"
    assert shared_folder(Session(**{"spark.checkpoint.dir": "hdfs://n/shared/"})) == "hdfs://n/shared"


def test_a_cascade_deletes_its_tables(spark):
    roster = spark.createDataFrame([(1, "Jo Ba", "t", "l", "d")], "player_id int, player_name_api string, team_name string, league_name string, extraction_date string")
    values = spark.createDataFrame([("jo ba", 1.0, "1")], "player_name string, market_value_eur double, market_value_raw string")
    kept = stored(matching.with_name_keys(roster, "player_name_api"), "roster")
    with Cascade(kept, stored(matching.with_name_keys(values, "player_name"), "values")) as cascade:
        assert cascade.match_rate().first().match_rate == 100.0
        paths = [table.stored_at for table in (cascade.listed, cascade.decisions, cascade.nearest, cascade.near)]
        assert all(Path(path).exists() for path in paths)
    assert not any(Path(path).exists() for path in paths)


def _above(plan, node):
    """What the rows of the topmost such node pass on their way out."""
    return plan[: plan.index(node)]


def test_pairs_of_level_two_are_not_shuffled(spark, small_thresholds):
    """They grow with the square of a last name's rows; before, they were joined to the roster rows."""
    roster = matching.with_name_keys(
        spark.createDataFrame(
            [(i, f"a{i} lo", "t", "l", "d") for i in range(40)],
            "player_id long, player_name_api string, team_name string, league_name string, extraction_date string",
        ),
        "player_name_api",
    )
    values = matching.with_name_keys(
        spark.createDataFrame(
            [(f"a{i}x lo", float(i), "r") for i in range(40)],
            "player_name string, market_value_eur double, market_value_raw string",
        ),
        "player_name",
    )
    with Cascade(roster, values) as cascade:
        rows = matching.initial_rows(roster, values, cascade.decisions)
        assert rows.count() == 1600
        plan = rows._jdf.queryExecution().executedPlan().toString()
        top = next(line for line in plan.splitlines() if "Join [" in line)
        assert "last_name" in top and "Exchange" not in _above(plan, top)


def test_only_near_pairs_leave_a_block(spark, small_thresholds):
    """All pairs of a last name, of which there may be thousands a name, are not sorted."""
    names = spark.createDataFrame([("al lo",), ("bo xy",)], "name_normalized string")
    values = [("all lo", 1.0, "a"), ("zzzzzz lo", 2.0, "b")]
    listed = matching.listed_names(
        matching.with_name_keys(
            spark.createDataFrame(values, "player_name string, market_value_eur double, market_value_raw string"),
            "player_name",
        )
    )
    best = nearest_names(names, listed)
    assert {tuple(r) for r in best.collect()} == {("al lo", 1, "all lo", 1.0, "a"), ("bo xy", None, None, None, None)}
    plan = best._jdf.queryExecution().executedPlan().toString()
    outer = next(line for line in plan.splitlines() if "Join [" in line and "LeftOuter" in line)
    assert "levenshtein" in outer
    assert " Exchange" not in _above(plan, outer)


def test_a_stored_table_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(CLEANUP)
    assert len(stored(spark.range(1000).repartition(4, "id"), "dealt").collect()) == 1000
    limit = time.time() + 20
    while (left := shuffled() - before) and time.time() < limit:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(CLEANUP) == setting


def test_levels_share_the_shuffle_of_the_roster(spark, small_thresholds):
    """Also where an output leaves out the keys that level two joins by."""
    roster = stored(
        matching.with_name_keys(
            spark.createDataFrame(
                [(1, "Jo Ba", "t", "l", "d"), (2, "J. Ba", "t", "l", "d"), (3, None, "t", "l", "d")],
                "player_id int, player_name_api string, team_name string, league_name string, extraction_date string",
            ),
            "player_name_api",
        ),
        "roster",
    )
    values = spark.createDataFrame([("jo ba", 1.0, "1")], "player_name string, market_value_eur double, market_value_raw string")
    with Cascade(roster, stored(matching.with_name_keys(values, "player_name"), "values")) as cascade:
        rows = cascade.rows().select("player_id", "player_name_api", "team_name", "match_type")
        assert {(r.player_id, r.match_type) for r in rows.collect()} == {(1, "exact"), (2, "lastname_initial")}
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan[: plan.index("Initial Plan")]
        winners = matching.best_candidates(roster, cascade.nearest)
        assert set(winners.columns) >= set(roster.columns)
        plan = winners._jdf.queryExecution().executedPlan().toString()
        assert "last_name" not in plan[plan.index("Join [") :]


def test_output_rows_stand_beside_few_tables(spark, small_thresholds):
    """Level three is done, and what it came from gone, before rows are shuffled for the output."""
    roster = spark.createDataFrame(
        [(1, "Jo Ba", "t", "l", "d"), (2, "Ja Ba", "t", "l", "d"), (3, None, "t", "l", "d")],
        "player_id int, player_name_api string, team_name string, league_name string, extraction_date string",
    )
    values = spark.createDataFrame([("jo ba", 1.0, "1")], "player_name string, market_value_eur double, market_value_raw string")
    sides = (matching.with_name_keys(roster, "player_name_api"), matching.with_name_keys(values, "player_name"))
    before = _tables(spark)
    with Cascade(*sides) as cascade:
        cascade.settle()
        rows = cascade.rows()
        assert sorted(path.name for path in _tables(spark) - before) == ["decisions", "near"]
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan
        assert {(r.player_id, r.match_type) for r in rows.collect()} == {(1, "exact"), (2, "lastname_initial")}
        assert cascade.listed.count() == 1 and cascade.nearest.count() == 0
    for name in ("match_cascade", "match_cascade_keep_unmatched", "cascade_union"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan


def _tables(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir")).glob("talentlake/*/*"))
