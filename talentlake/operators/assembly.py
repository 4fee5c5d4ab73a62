"""Landed API responses to entries, errors and counts.

A landed page has ``team_id``, ``team_name``, ``page``, ``error`` (NULL if it arrived) and
``response``, an array. Nothing is gathered into one payload; entries stay rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status codes worth another try, and the text of an exhausted quota.
RETRYABLE_STATUS = (429, 500, 502, 503, 504)
QUOTA_TEXT = "request limit"
# The teams to ask for when the team list comes back empty.
DEFAULT_TEAM_IDS = (
    77, 79, 80, 81, 82, 83, 84, 85, 91, 93, 94, 95, 96, 106, 108, 111, 112, 116, 1063,
)


def page_entries(pages: DataFrame) -> DataFrame:
    """One row per response entry of the pages that arrived, over all teams."""
    return pages.where("error is null").select(
        "team_id", "team_name", "page", F.explode("response").alias("entry")
    )


def page_errors(pages: DataFrame) -> DataFrame:
    """One row per page that failed."""
    return pages.where("error is not null").select("team_id", "team_name", "page", "error")


def page_summary(pages: DataFrame) -> DataFrame:
    """Per team: entries, non-empty blocks that arrived, and failed pages."""
    arrived = F.col("error").isNull()
    entries = F.when(arrived & (F.size("response") > 0), F.size("response")).otherwise(0)
    return pages.groupBy("team_id", "team_name").agg(
        F.sum(entries).alias("results"),
        F.count_if(entries > 0).alias("ok_blocks"),
        F.count_if(~arrived).alias("failed_pages"),
    )


def page_parts(pages: DataFrame) -> DataFrame:
    """(part, team_name, n) to be added up: what ``page_entries``, ``page_errors``,
    ``page_summary`` and ``team_list`` say of the pages, each page read once."""
    arrived, team = F.col("error").isNull(), F.col("team_name")
    entries = F.when(arrived, F.coalesce(F.size("response"), F.lit(0))).otherwise(0)

    def part(name: str, of: Column, n: Column) -> Column:
        return F.struct(F.lit(name).alias("part"), of.alias("team_name"), n.cast("bigint").alias("n"))

    failed = (~arrived).cast("int")
    counted = F.filter(F.array(part("entries", team, entries), part("errors", team, failed)), lambda p: p["n"] > 0)
    summary = F.array(
        part("results", team, entries),
        part("ok_blocks", team, (entries > 0).cast("int")),
        part("failed_pages", team, failed),
    )
    with_id = F.filter(F.when(arrived, F.col("response")), lambda entry: entry["team"]["id"] != 0)
    teams = F.transform(with_id, lambda entry: part("with id", _team_label(entry["team"]), F.lit(1)))
    return pages.select(F.inline(F.concat(counted, summary, F.coalesce(teams, F.slice(summary, 1, 0)))))


def _team_label(team: Column) -> Column:
    return F.coalesce(team["name"], F.concat(F.lit("team_"), team["id"].cast("string")))


def team_list(team_envelopes: DataFrame) -> DataFrame:
    """Ids and names of the team list; entries without an id, or with id 0, are skipped, and a
    team without a name is named by its id."""
    team = F.col("entry.team")
    return (
        team_envelopes.select(F.explode("response").alias("entry"))
        .select(team["id"].alias("team_id"), _team_label(team).alias("team_name"))
        .where("team_id <> 0")
    )


def or_default(rows: DataFrame, defaults: DataFrame) -> DataFrame:
    """``rows``, or ``defaults`` when there are none."""
    return rows.unionByName(defaults.where(~rows.exists()))


def default_teams(ids: DataFrame) -> DataFrame:
    """A team named by its id for every ``team_id``."""
    name = F.concat(F.lit("team_"), F.col("team_id").cast("string"))
    return ids.select(F.col("team_id").cast("bigint"), name.alias("team_name"))


def quota_reached(body: Column) -> Column:
    """Whether a response body reports an exhausted request quota."""
    message = F.lower(F.get_json_object(body, "$.errors.requests"))
    return F.coalesce(message.contains(QUOTA_TEXT), F.lit(False))


def triage(responses: DataFrame, status: str = "status", body: str = "body") -> DataFrame:
    """Add what to do with a response: ``retry``, ``quota`` (reuse a snapshot) or ``ok``."""
    retryable = F.coalesce(F.col(status).isin(*RETRYABLE_STATUS), F.lit(False))
    quota = quota_reached(F.col(body))
    return responses.withColumns(
        {
            "retryable": retryable,
            "quota": quota,
            "outcome": F.when(retryable, "retry").when(quota, "quota").otherwise("ok"),
        }
    )


MAX_ATTEMPTS = 3


def last_attempts(responses: DataFrame, day: str = "day", team: str = "team_id", attempt: str = "attempt") -> DataFrame:
    """Per day and team the triage of its last attempt, ``attempts``, and ``quota`` if any attempt
    met an exhausted quota. Aggregates only, so a team asked very often is a few rows."""
    judged = triage(responses)
    return judged.groupBy(day, team).agg(
        F.max_by(F.struct("outcome", "body"), attempt).alias("last"),
        F.count("*").alias("attempts"),
        F.bool_or("quota").alias("quota"),
    ).select(day, team, "last.outcome", "last.body", "attempts", "quota")


def verdicts(attempts: DataFrame, arrived: Column, day: str = "day", max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Per day what its responses come to: ``quota`` (reuse the last snapshot), ``retry`` (a team
    may still be asked again), ``ok`` (some arrived) or ``empty`` (none did). ``arrived`` says
    whether a team's last response brought anything."""
    open_ = (F.col("outcome") == "retry") & (F.col("attempts") < max_attempts)
    found = (F.col("outcome") == "ok") & arrived
    counts = attempts.groupBy(day).agg(
        F.count("*").alias("teams"),
        F.count_if(found).alias("ok_teams"),
        F.count_if(open_).alias("open_teams"),
        F.bool_or("quota").alias("quota"),
    )
    verdict = (
        F.when(F.col("quota"), "quota")
        .when(F.col("open_teams") > 0, "retry")
        .when(F.col("ok_teams") > 0, "ok")
        .otherwise("empty")
    )
    return counts.withColumn("verdict", verdict)
