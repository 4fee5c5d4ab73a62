"""Raw feeds to the formatted zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talentlake.functions.money import market_value_eur
from talentlake.functions.text import full_name

# Fixed value: the league of the roster feed, which does not name it.
ROSTER_LEAGUE = "Ligue 1"


def explode_response(envelopes: DataFrame) -> DataFrame:
    """One row per entry of ``response``; a NULL or empty one gives none."""
    return envelopes.select(F.explode("response").alias("entry"))


def explode_nested(envelopes: DataFrame) -> DataFrame:
    """One row per player of every team block, the team's fields beside it."""
    return explode_response(envelopes).select(
        F.col("entry.team.id").alias("team_id"),
        F.col("entry.team.name").alias("team_name"),
        F.explode("entry.players").alias("player"),
    )


def player_stats(envelopes: DataFrame, day: str) -> DataFrame:
    """Player-stats feed: names, and team and league of the first statistics element."""
    return player_stats_of_entries(explode_response(envelopes), day)


def player_stats_of_entries(entries: DataFrame, day: str) -> DataFrame:
    """``player_stats`` of the entries (column ``entry``) of the envelopes."""
    player = "entry.player"
    # get() gives NULL for an empty array, where [0] raises in ANSI mode.
    first = F.get("entry.statistics", F.lit(0))
    return entries.select(
        F.col(f"{player}.id").alias("player_id"),
        F.col(f"{player}.name").alias("player_name_api"),
        F.col(f"{player}.firstname").alias("firstname"),
        F.col(f"{player}.lastname").alias("lastname"),
        full_name(F.col(f"{player}.firstname"), F.col(f"{player}.lastname")).alias(
            "player_name_full_api"
        ),
        first["team"]["name"].alias("team_name"),
        first["league"]["name"].alias("league_name"),
        F.lit(day).alias("extraction_date"),
    )


def rosters(envelopes: DataFrame, day: str, league: str = ROSTER_LEAGUE) -> DataFrame:
    """Roster feed: one row per player and team; rows lacking id, name or team dropped."""
    return (
        explode_nested(envelopes)
        .select(
            F.col("player.id").alias("player_id"),
            F.col("player.name").alias("player_name_api"),
            "team_name",
            F.lit(league).alias("league_name"),
            F.lit(day).alias("extraction_date"),
        )
        .dropna(subset=["player_id", "player_name_api", "team_name"])
    )


def market_values(raw: DataFrame, day: str) -> DataFrame:
    """Market-value feed with its amount in EUR."""
    return raw.select(
        "player_name",
        "market_value_raw",
        "scraped_url",
        market_value_eur(F.col("market_value_raw")).alias("market_value_eur"),
        F.lit(day).alias("extraction_date"),
    )
