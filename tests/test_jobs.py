"""A lake of three days through all jobs."""

import json

import pytest

from talentlake import schemas
from talentlake.plans import jobs


def land(lake, feed, day, payload):
    folder = lake / "raw" / feed / day
    folder.mkdir(parents=True)
    (folder / "feed.json").write_text(json.dumps(payload, indent=2), encoding="utf-8")


def roster(*names):
    players = [{"id": i, "name": n} for i, n in enumerate(names, 1)]
    return {"get": "players/squads", "response": [{"team": {"id": 7, "name": "A"}, "players": players}]}


def values(**raw):
    return [{"player_name": n.replace("_", " "), "market_value_raw": r} for n, r in raw.items()]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    land(folder, "rosters", "20240101", roster("J. Ba", "Al Li", "No One"))
    land(folder, "market_values", "20240101", values(Jo_Ba="2 mio. €", Al_Li="500 K €"))
    land(folder, "market_values", "20240102", values(Jo_Ba="4 mio. €"))
    land(folder, "rosters", "20240103", roster("J. Ba"))
    for day in ("20240101", "20240102", "20240103"):
        jobs.format_rosters(spark, str(folder), day)
        jobs.format_values(spark, str(folder), day)
        jobs.combine(spark, str(folder), day)
    return str(folder)


def final(spark, lake, first, last):
    rows = jobs.final_rows(spark, lake, first, last).orderBy("event_time", "player_id")
    return [(r.event_time, r.player_id, r.match_type, r.value_index) for r in rows.collect()]


def test_final_table_over_days(spark, lake):
    assert final(spark, lake, "20240101", "20240103") == [
        ("20240101", 1, "lastname_initial", 100.0),
        ("20240101", 2, "exact", 25.0),
        # The roster of the day before, since that day's never landed; the third day's
        # market values did not land either, so it has no match at all.
        ("20240102", 1, "lastname_initial", 100.0),
    ]
    assert final(spark, lake, "20240102", "20240102") == [("20240102", 1, "lastname_initial", 100.0)]


def test_rerun_keeping_unmatched_replaces_its_day(spark, lake):
    cascade = jobs.combine(spark, lake, "20240102", keep_unmatched=True)
    assert cascade.match_rate().first().player_match_rate == pytest.approx(100 / 3)
    assert [r[:3] for r in final(spark, lake, "20240102", "20240102")] == [
        ("20240102", 1, "lastname_initial"),
        ("20240102", 2, "no_match"),
        ("20240102", 3, "no_match"),
    ]
    assert len(final(spark, lake, "20240101", "20240101")) == 2
    jobs.combine(spark, lake, "20240102")


def test_combine_counts_what_it_writes(spark, lake):
    cascade = jobs.combine(spark, lake, "20240101")
    assert cascade.written == {"rows": 2, "exact": 1, "lastname_initial": 1, "fuzzy": 0, "no_match": 0}
    assert cascade.name_totals["exact_rows"] == 1 and cascade.near_totals["fuzzy_rows"] == 0


def test_published_rows_are_one_per_player(spark, lake):
    published = spark.read.parquet(f"{lake}/{jobs.PUBLISHED}").where("event_time = '20240101'")
    rows = [(r.player_id, r.match_type, r.value_index) for r in published.orderBy("player_id").collect()]
    assert rows == [(1, "lastname_initial", 100.0), (2, "exact", 25.0)]


def test_publish(spark, lake):
    assert jobs.publish(spark, lake, "20240101") == {"indexed": 2, "failed": 0}
    bulk = spark.read.text(f"{lake}/index/event_date=20240101").collect()
    assert len(bulk) == 4


def test_player_stats_producer(spark, tmp_path):
    entry = {
        "player": {"id": 5, "name": "Jo Ba", "firstname": "Jo", "lastname": "Ba"},
        "statistics": [{"team": {"name": "A"}, "league": {"name": "L"}}],
    }
    land(tmp_path, "player_stats", "20240101", {"get": "x", "response": [entry]})
    land(tmp_path, "market_values", "20240101", values(Jo_Ba="7 M."))
    lake = str(tmp_path)
    jobs.format_player_stats(spark, lake, "20240101")
    jobs.format_values(spark, lake, "20240101")
    jobs.combine(spark, lake, "20240101")
    assert final(spark, lake, "20240101", "20240101") == [("20240101", 5, "exact", 100.0)]


def test_a_day_is_replaced_by_nothing(spark, tmp_path):
    """A rerun whose values are gone, and one in which nobody matches, leave an empty day."""
    lake, day = str(tmp_path), "20240101"
    land(tmp_path, "rosters", day, roster("Jo Ba"))
    land(tmp_path, "market_values", day, values(Jo_Ba="2 mio. €"))

    def run():
        jobs.format_rosters(spark, lake, day)
        jobs.format_values(spark, lake, day)
        jobs.combine(spark, lake, day)
        return len(final(spark, lake, day, day)), jobs.publish(spark, lake, day)["indexed"]

    assert run() == (1, 1)
    (tmp_path / "raw" / "market_values" / day / "feed.json").write_text(json.dumps(values(Xx_Yy="1 mio. €")))
    assert run() == (0, 0)
    assert spark.read.text(f"{lake}/index/event_date={day}").count() == 0


def test_empty_roster_reuses_the_last_one(spark, tmp_path):
    lake = str(tmp_path)
    land(tmp_path, "rosters", "20240101", roster("Jo Ba", "Al Li"))
    land(tmp_path, "rosters", "20240102", {"get": "players/squads", "response": []})
    jobs.format_rosters(spark, lake, "20240101")
    jobs.format_rosters(spark, lake, "20240102")
    jobs.format_rosters(spark, lake, "20240102")
    stats = spark.read.parquet(f"{lake}/formatted/stats")
    assert sorted(r["count"] for r in stats.groupBy("extraction_date").count().collect()) == [2, 2]
    with pytest.raises(ValueError):
        jobs.format_rosters(spark, str(tmp_path / "nowhere"), "20240101")


def respond(lake, day, *responses):
    folder = lake / "raw" / "roster_responses" / day
    folder.mkdir(parents=True, exist_ok=True)
    lines = [
        json.dumps({"team_id": team, "attempt": attempt, "status": status, "body": body and json.dumps(body)})
        for team, attempt, status, body in responses
    ]
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(lines))


def names_of(spark, lake, day):
    stats = spark.read.schema(schemas.STATS_FORMATTED).parquet(f"{lake}/formatted/stats")
    return sorted(r.player_name_api for r in stats.where(f"extraction_date = '{day}'").collect())


QUOTA = {"errors": {"requests": "You have reached the request limit for the day"}}


def test_roster_follows_the_verdict_of_its_responses(spark, tmp_path):
    lake = str(tmp_path)
    respond(tmp_path, "20240101", (7, 1, 503, None), (7, 2, 200, roster("Jo Ba", "Al Li")), (8, 1, 404, {"response": []}))
    assert jobs.format_roster_responses(spark, lake, "20240101") == "ok"
    assert names_of(spark, lake, "20240101") == ["Al Li", "Jo Ba"]

    # A quota, even after a team that arrived, means the last roster.
    respond(tmp_path, "20240102", (7, 1, 200, roster("New One")), (8, 1, 200, QUOTA))
    assert jobs.format_roster_responses(spark, lake, "20240102") == "quota"
    assert names_of(spark, lake, "20240102") == ["Al Li", "Jo Ba"]

    # A response that may still come does not; later it is there, or all attempts are spent.
    respond(tmp_path, "20240103", (7, 1, 200, roster("New One")), (8, 1, 429, None))
    assert jobs.format_roster_responses(spark, lake, "20240103") == "retry"
    assert names_of(spark, lake, "20240103") == []
    respond(tmp_path, "20240103", (8, 2, 500, None), (8, 3, 502, None))
    assert jobs.format_roster_responses(spark, lake, "20240103") == "ok"
    assert names_of(spark, lake, "20240103") == ["New One"]

    # Nothing arrived in all attempts, or nothing landed at all.
    respond(tmp_path, "20240104", *[(7, i, 503, None) for i in (1, 2, 3)])
    assert jobs.format_roster_responses(spark, lake, "20240104") == "empty"
    assert jobs.format_roster_responses(spark, lake, "20240105") == "empty"
    assert names_of(spark, lake, "20240104") == names_of(spark, lake, "20240105") == ["New One"]

    state = spark.read.parquet(f"{lake}/{jobs.STATE}").orderBy("extraction_date").collect()
    assert [(str(r.extraction_date), r.verdict, r.ok_teams) for r in state] == [
        ("20240101", "ok", 1), ("20240102", "quota", 1), ("20240103", "ok", 1), ("20240104", "empty", 0)
    ]


def test_quota_without_any_roster_fails(spark, tmp_path):
    respond(tmp_path, "20240101", (7, 1, 200, QUOTA))
    with pytest.raises(ValueError):
        jobs.format_roster_responses(spark, str(tmp_path), "20240101")
