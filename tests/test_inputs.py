"""How the landed inputs are made of the documents."""

import pytest
from pyspark.sql import functions as F

from talentlake.plans import inputs, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("envelopes", (inputs.player_stats_envelopes, inputs.roster_envelopes))
def test_texts_are_dealt_not_the_players_made_of_them(spark, envelopes):
    plan = envelopes(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert plan.index("Generate") < plan.index("Exchange")


def test_landed_files_are_compressed(spark):
    assert inputs.land_envelopes(spark, SF_DIR, inputs.roster_envelopes).endswith(".json.gz")
    assert inputs.land_values(spark, SF_DIR).endswith(".txt.gz")


def test_one_envelope_a_file_for_odd_numbers(spark, tmp_path):
    """Also where the files of negative numbers overlap, and for texts without a number."""
    numbers = (None, None, -129, -65, -64, -1, 0, 63, 64, 1000)
    rows = [(n, "a bc d e f g " * 1500, "web", "en") for n in numbers]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string, lang string").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    wanted = inputs.roster_raw(spark, str(tmp_path)).groupBy(inputs._shard()).agg(F.count("*").cast("int"))
    wanted = {tuple(row) for row in wanted.collect()}
    assert len(wanted) > 10
    found = inputs.player_stats_envelopes(spark, str(tmp_path)).select("shard", "results").collect()
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)
    squads = inputs.roster_envelopes(spark, str(tmp_path)).select("shard", F.explode("response.players").alias("p"))
    counted = squads.groupBy("shard").agg(F.sum(F.size("p")).cast("int")).collect()
    assert {tuple(row) for row in counted} == wanted


@pytest.mark.parametrize("name", ("exact_match", "residual_split", "lastname_initial_match", "name_normalize", "edit_distance"))
def test_what_is_read_once_is_not_landed(spark, name):
    before = dict(inputs._landed)
    plan = queries.QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert inputs._landed == before
    assert "REPARTITION_BY_NUM" in plan  # the texts are dealt, a file of them is not one task


def test_landed_sides_hold_no_cut_keys(spark):
    roster, values = inputs.roster(spark, SF_DIR), inputs.values(spark, SF_DIR)
    assert {"name_normalized", "last_name", "first_initial"} <= set(roster.columns) & set(values.columns)
    for key, path in inputs._landed.items():
        if key[-1] in ("roster_named", "values_named"):
            assert "name_normalized" in (landed := spark.read.parquet(path).columns)
            assert not {"last_name", "first_initial", "player_name"} & set(landed)
    assert not any(key[-1] in ("people_of_documents", "roster_keyed") for key in inputs._landed)
