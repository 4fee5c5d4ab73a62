"""The daily jobs over a lake folder: format, combine, publish.

    raw/<feed>/<day>/*.json         landed feeds
    raw/roster_responses/<day>/     landed responses of the roster feed, a JSON line each
    state/roster_responses          what they came to, partitioned by extraction_date
    formatted/stats, .../values     partitioned by extraction_date
    usage/player_values             partitioned by event_time
    usage/published                 of these, the row of each player that is published
    index                           bulk files, partitioned by event_date

A rerun of a day replaces that day and no other.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake import schemas
from talentlake.operators import assembly, formatting, matching, scoring
from talentlake.operators.cascade import Cascade
from talentlake.sources import feeds, search_documents, snapshots
from talentlake.workspace import stored

STATS, VALUES, USAGE, INDEX = "formatted/stats", "formatted/values", "usage/player_values", "index"
PUBLISHED, STATE = "usage/published", "state/roster_responses"


def _raw(lake: str, feed: str, day: str) -> str:
    return f"{lake}/raw/{feed}/{day}/*.json"


def format_rosters(
    spark: SparkSession, lake: str, day: str, league: str = formatting.ROSTER_LEAGUE
) -> None:
    """Roster feed to ``formatted/stats``. A feed that did not land, or that holds no player (an
    empty, corrupt or quota response), leaves the day as it is or reuses the last one before."""
    landed = feeds.feed_or_none(spark, _raw(lake, "rosters", day), schemas.ROSTER_ENVELOPE)
    if landed is not None:
        stats = formatting.rosters(landed, day, league)
        if not stats.isEmpty():
            snapshots.replace_day(stats, f"{lake}/{STATS}", day, "extraction_date")
            return
    _reuse_roster(spark, lake, day)


def _reuse_roster(spark: SparkSession, lake: str, day: str) -> None:
    """Leave the day's roster as it is, or make it the last one before."""
    try:
        reused = snapshots.read_as_of(spark, f"{lake}/{STATS}", schemas.STATS_FORMATTED, day, "extraction_date")
        last = reused.select("extraction_date").first()
    except AnalysisException:  # nothing was ever written
        last = None
    if last is None:
        raise feeds.MissingResponseError(f"no roster landed for {day} and there is none before it")
    if last["extraction_date"] != day:
        again = reused.withColumn("extraction_date", F.lit(day))
        snapshots.replace_day(again, f"{lake}/{STATS}", day, "extraction_date")


def format_roster_responses(
    spark: SparkSession, lake: str, day: str, league: str = formatting.ROSTER_LEAGUE
) -> str:
    """Landed responses of the roster feed, team by team, to ``formatted/stats``; returns the
    day's verdict, which is also kept as state.

    ``quota``: one response reports an exhausted quota, so the last roster is reused. ``retry``:
    teams may still be asked again, nothing changes yet. ``ok``: the teams that arrived are the
    roster. ``empty``: none arrived in all attempts, so the last roster is reused."""
    path = f"{lake}/raw/roster_responses/{day}/*.json"
    landed = feeds.feed_or_empty(spark, path, schemas.ROSTER_RESPONSE, multi_line=False)
    attempts = assembly.last_attempts(landed.withColumn("day", F.lit(day)))
    envelopes = attempts.withColumn("envelope", F.from_json("body", schemas.ROSTER_ENVELOPE))
    judged = stored(envelopes, "responses")
    arrived = F.coalesce(F.size("envelope.response") > 0, F.lit(False))
    state = assembly.verdicts(judged, arrived)
    verdict = state.first()
    outcome = verdict["verdict"] if verdict else "empty"
    row = state.withColumnRenamed("day", "extraction_date")
    snapshots.replace_day(row, f"{lake}/{STATE}", day, "extraction_date")
    if outcome == "ok":
        roster = formatting.rosters(judged.where(F.col("outcome") == "ok").select("envelope.*"), day, league)
        if snapshots.replace_day(roster, f"{lake}/{STATS}", day, "extraction_date")["rows"]:
            return outcome
        outcome = "empty"
    if outcome != "retry":
        _reuse_roster(spark, lake, day)
    return outcome


def format_player_stats(spark: SparkSession, lake: str, day: str) -> None:
    """Player-stats feed to ``formatted/stats``, the other producer of that table."""
    landed = feeds.read_feed(spark, _raw(lake, "player_stats", day), schemas.PLAYER_STATS_ENVELOPE)
    stats = formatting.player_stats(feeds.require_response(landed), day)
    snapshots.replace_day(stats, f"{lake}/{STATS}", day, "extraction_date")


def format_values(spark: SparkSession, lake: str, day: str) -> None:
    """Market-value feed to ``formatted/values``; a day without feed has no rows."""
    landed = feeds.feed_or_empty(spark, _raw(lake, "market_values", day), schemas.MARKET_VALUES)
    values = formatting.market_values(landed, day)
    snapshots.replace_day(values, f"{lake}/{VALUES}", day, "extraction_date")


def combine(spark: SparkSession, lake: str, day: str, keep_unmatched: bool = False) -> Cascade:
    """Link the day's two tables and write the final one, and the rows of it that are published;
    returns the cascade for its metrics, with ``written``, the rows of each match type as they
    were counted while being written."""

    def of_day(path: str, schema: str, name: str) -> DataFrame:
        table = snapshots.read_snapshots(spark, f"{lake}/{path}", schema)
        return matching.with_name_keys(table.where(F.col("extraction_date") == day), name)

    cascade = Cascade(
        of_day(STATS, schemas.STATS_FORMATTED, "player_name_api"),
        of_day(VALUES, schemas.VALUES_FORMATTED, "player_name"),
    )
    final = scoring.score(cascade, day, keep_unmatched)
    kinds = (matching.EXACT, matching.INITIAL, matching.FUZZY, matching.NO_MATCH)
    observed = {kind: F.count_if(F.col("match_type") == kind) for kind in kinds}
    cascade.written = snapshots.replace_day(final, f"{lake}/{USAGE}", day, "event_time", **observed)
    published = scoring.best_per_player(cascade, day, keep_unmatched)
    snapshots.replace_day(published, f"{lake}/{PUBLISHED}", day, "event_time")
    return cascade


def final_rows(spark: SparkSession, lake: str, first: str, last: str) -> DataFrame:
    """Final rows of all days from ``first`` to ``last``."""
    usage = snapshots.read_snapshots(spark, f"{lake}/{USAGE}", schemas.FINAL)
    return snapshots.between(usage, first, last, "event_time")


def publish(spark: SparkSession, lake: str, day: str) -> dict[str, int]:
    """The day's search documents as bulk files, one per player; returns their counts."""
    published = snapshots.read_snapshots(spark, f"{lake}/{PUBLISHED}", schemas.FINAL)
    documents = search_documents.search_documents(published.where(F.col("event_time") == day))
    return search_documents.write_bulk(documents, f"{lake}/{INDEX}", day)
