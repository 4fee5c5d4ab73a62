"""Every registered query against its SQL, and the plans that matter at scale."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
from oracle import differences, duck
from talentlake.operators import matching, nearest
from talentlake.plans import inputs
from talentlake.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql())
    assert set(QUERIES) <= set(driver.queries())


def test_driver_works_without_the_optional_operators():
    """Also where a package they need is missing."""
    code = (
        "import sys, warnings; warnings.simplefilter('ignore'); sys.modules[%r] = None\n"
        "import __spark_entry__ as driver\n"
        "assert set(driver.queries()) == set(driver.oracle_sql()) and len(driver.queries()) >= 48"
    )
    root = Path(driver.__file__).parent
    for missing in ("talentlake.llm", "xxhash"):
        subprocess.run([sys.executable, "-c", code % missing], cwd=root, check=True)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    """Equal to its SQL; and its plan stays in the JVM (but for the HTML parser's) and pairs
    rows by keys only."""
    df = QUERIES[name](spark, SF_DIR)
    text = plan(df)
    assert ("InPandas" in text) == (name == "html_table_extract")
    for node in ("PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text
    assert differences(df, con, driver.oracle_sql()[name]) == ""


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert rows and all(0.0 <= r.value_index <= 100.0 for r in rows)


def test_scan_is_pruned_and_filtered(spark):
    text = plan(QUERIES["parquet_scan"](spark, SF_DIR))
    assert "EqualTo(l_returnflag,R)" in text and "GreaterThanOrEqual(l_quantity,25.0)" in text
    schema = text[text.index("ReadSchema") :]
    assert "l_shipdate" not in schema and "l_comment" not in schema


def test_pages_are_read_once(spark):
    assert plan(QUERIES["page_assembly"](spark, SF_DIR)).count("FileScan") == 1


def test_crowded_names_take_both_routes(spark, monkeypatch):
    taken = []
    for route in ("_by_patterns", "_by_segments"):
        function = getattr(nearest, route)
        monkeypatch.setattr(nearest, route, lambda *a, r=route, f=function: (taken.append(r), f(*a))[1])
    found = QUERIES["crowded_names"](spark, "/root/testdata/sf0.01")
    assert taken == ["_by_patterns", "_by_segments"]
    lengths = {len(r.v_name.split(" ")[0]) > nearest.PATTERN_LENGTH for r in found.where("distance between 1 and 3").collect()}
    assert lengths == {True, False}


def test_ranking_is_limited_before_the_shuffle(spark):
    for name in ("best_candidate", "upsert_latest"):
        assert "WindowGroupLimit" in plan(QUERIES[name](spark, SF_DIR))


def test_top_players_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_players"](spark, SF_DIR))


def test_lookups_shuffle_both_sides_for_the_join_alone(spark):
    """A join side that is an aggregate's own partitioning could not be split when skewed."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        roster, values = inputs.roster(spark, SF_DIR), inputs.values(spark, SF_DIR)
        text = plan(matching.name_decisions(roster, matching.listed_names(values)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(initial_key") == 2
