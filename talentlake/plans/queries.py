"""One registered query per operator. Each takes (spark, directory of the tables)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake import schemas
from talentlake.functions import days, money, text
from talentlake.operators import assembly, formatting, latest, matching, scoring
from talentlake.operators.cascade import Cascade
from talentlake.operators.nearest import nearest_names, store_nearest
from talentlake.plans import inputs
from talentlake.plans.inputs import RUN_DAY, table
from talentlake.sources import feeds, html_rows, large_feeds, search_documents, snapshots
from talentlake.workspace import discard, fresh_path, in_pass, passes_over, stored, stored_parts

LINK = ["player_id", "player_name_api", "team_name"]
MATCH = [*LINK, "market_value_eur", "market_value_raw", "match_type"]


# --- scans, sources, sinks ---------------------------------------------------------------


def parquet_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 25))
        .select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )


def json_envelope_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.land_envelopes(spark, sf_dir, inputs.player_stats_envelopes)
    envelopes = feeds.read_feed(spark, path, schemas.PLAYER_STATS_ENVELOPE)
    return envelopes.select(
        "get",
        F.col("parameters.league").alias("league"),
        F.col("parameters.season").alias("season"),
        "results",
        F.size("response").alias("entries"),
        F.get("errors", F.lit(0))["team_id"].alias("failed_team_id"),
    )


def json_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.read_feed(spark, inputs.land_values(spark, sf_dir), schemas.MARKET_VALUES)


def empty_source_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two feeds of a day, one of which never landed."""
    landed = feeds.feed_or_empty(spark, inputs.land_values(spark, sf_dir), schemas.MARKET_VALUES)
    nowhere = fresh_path(spark, "absent") + "/*.json"
    absent = feeds.feed_or_empty(spark, nowhere, schemas.MARKET_VALUES)
    return formatting.market_values(landed, RUN_DAY).unionByName(
        formatting.market_values(absent, RUN_DAY)
    )


def envelope_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    envelopes = feeds.require_response(inputs.stats_feed(spark, sf_dir))
    return envelopes.select("shard", "results")


def snapshot_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days written, then one of them again with doubled values, and one with none."""
    events = inputs.daily_events(spark, sf_dir).select("event_id", "value", snapshots.DAY)
    path = fresh_path(spark, "snapshots")
    snapshots.write_snapshot(events, path)
    again = events.where(F.col(snapshots.DAY) == "20240115").withColumn("value", F.col("value") * 2)
    snapshots.write_snapshot(again, path)
    snapshots.replace_day(events.where("false"), path, "20240116")
    return snapshots.read_snapshots(spark, path, events.schema)


def multi_date_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.daily_events(spark, sf_dir).select("event_type", "value", snapshots.DAY)
    path = fresh_path(spark, "snapshots")
    snapshots.write_snapshot(events, path)
    stored = snapshots.read_snapshots(spark, path, events.schema)
    return (
        snapshots.between(stored, "20240105", "20240120")
        .groupBy(snapshots.DAY, "event_type")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total_value"))
    )


def snapshot_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every shipping day, the last day with orders up to it."""
    def present(name: str, moment: str, day: str) -> DataFrame:
        # Distinct dates first, so that few are left to be formatted.
        dates = table(spark, sf_dir, name).select(F.to_date(moment).alias("date")).distinct()
        return dates.select(days.day_key(F.col("date")).alias(day))

    ordered = present("orders", "o_orderdate", snapshots.DAY)
    return snapshots.choose_days(present("lineitem", "l_shipdate", "as_of"), ordered)


AS_OF_DAYS = ("19000101", "20240103", "20240115", "20240118", "20991231")


def snapshot_read_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a lake without every third day of the month shows as of some days: before its first
    day, in a gap, on a day, and after its last."""
    events = inputs.daily_events(spark, sf_dir).select("event_id", "value", snapshots.DAY)
    path = fresh_path(spark, "snapshots")
    snapshots.write_snapshot(events.where(F.substring(snapshots.DAY, 7, 2).cast("int") % 3 != 0), path)
    parts = [
        snapshots.read_as_of(spark, path, events.schema, as_of).withColumn("as_of", F.lit(as_of)) for as_of in AS_OF_DAYS
    ]
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("as_of", snapshots.DAY)
        .agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
    )


def page_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What landed pages amount to, by team: their entries, failures and counts. As a team list,
    the entries stand for teams that are named by the order status."""
    parts = assembly.page_parts(inputs.order_pages(spark, sf_dir))
    return parts.groupBy("part", "team_name").agg(F.sum("n").alias("n"))


def dimension_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams from an empty list, and from one that is not."""
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("team_id"), F.col("n_name").alias("team_name")
    )
    defaults = assembly.default_teams(
        table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("team_id"))
    )
    empty = assembly.or_default(nation.where("team_name is null"), defaults)
    filled = assembly.or_default(nation, defaults)
    return empty.withColumn("input", F.lit("empty")).unionByName(
        filled.withColumn("input", F.lit("filled"))
    )


def response_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(
        F.array(*[F.lit(s) for s in (200, 429, 500, 404, 200, 502, 503, 504)]),
        (F.col("event_id") % 8 + 1).cast("int"),
    )
    message = F.when(
        F.col("event_type") == "error", F.lit("You have reached the Request Limit for the day")
    ).otherwise(F.col("event_type"))
    body = F.to_json(F.struct(F.struct(message.alias("requests")).alias("errors")))
    landed = table(spark, sf_dir, "events").select(
        "event_id", status.alias("status"), body.alias("body")
    )
    return assembly.triage(landed).drop("body")


def response_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the responses of every day come to."""
    last = assembly.last_attempts(inputs.attempts(spark, sf_dir))
    return assembly.verdicts(last, F.col("team_id") % 2 == 0)


def html_rows_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return html_rows.link_items(pages)


def html_table_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' list items as rows of a market-value table, through the parser."""
    row = (
        '<tr><td class="x"><table><tr><td class="hauptlink"><a href="#">$2</a></td></tr></table>'
        '</td><td class="rechts">-</td><td class="rechts last"> $1 </td></tr>'
    )
    listed = F.regexp_replace("html", r'(?is)<li\b[^>]*><a href="([^"]*)">(.*?)</a></li>', row)
    opened = F.regexp_replace(listed, r"(?i)<ul>", '<table class="items"><tbody>')
    pages = table(spark, sf_dir, "pages").select(
        "url", F.regexp_replace(opened, r"(?i)</ul>", "</tbody></table>").alias("html")
    )
    return html_rows.table_rows(pages)


def bulk_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published documents, one per id, read back from their bulk files, with the counts."""
    rows = _rounded(scoring.best_per_player(_cascade(spark, sf_dir), RUN_DAY))
    path = fresh_path(spark, "bulk")
    counts = search_documents.write_bulk(search_documents.search_documents(rows), path, RUN_DAY, "gzip")
    source = "player_id bigint, player_name_api string, team_name string, match_type string, market_value_eur double"
    lines = spark.read.text(path).where(~F.startswith("value", F.lit('{"index":')))
    return lines.select(F.from_json("value", source).alias("source")).select(
        "source.*",
        F.lit(counts["indexed"]).cast("bigint").alias("indexed"),
        F.lit(counts["failed"]).cast("bigint").alias("failed"),
    )


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the final table, their JSON source read back field by field."""
    documents = search_documents.search_documents(_final(spark, sf_dir))
    fields = f"{schemas.FINAL}, `@timestamp` string"
    return documents.select("_index", "_id", F.from_json("_source", fields).alias("source")).select(
        "_index",
        "_id",
        *[F.col(f"source.{c}") for c in LINK],
        "source.market_value_eur",
        F.round("source.value_index", 6).alias("value_index"),
        "source.match_type",
        "source.event_time",
        F.col("source.@timestamp").alias("indexed_at"),
    )


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written under one id per user and day; the last one stays."""
    events = inputs.daily_events(spark, sf_dir).select(
        F.concat_ws("_", "user_id", snapshots.DAY).alias("_id"), "ts", "event_id", "value"
    )
    return latest.latest(events, ["_id"], [F.desc("ts"), F.desc("event_id")]).drop("ts")


# --- projections, filters, formats -------------------------------------------------------


def explode_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = formatting.explode_response(inputs.stats_feed(spark, sf_dir))
    return entries.select(
        F.col("entry.player.id").alias("player_id"),
        F.col("entry.player.name").alias("player_name_api"),
        F.size("entry.statistics").alias("n_statistics"),
    )


def nested_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = formatting.explode_response(inputs.stats_feed(spark, sf_dir))
    return entries.select(
        F.col("entry.player.id").alias("player_id"),
        F.col("entry.player.firstname").alias("firstname"),
        F.col("entry.player.lastname").alias("lastname"),
        F.concat_ws("|", "entry.statistics.team.name").alias("team_names"),
    )


def first_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = formatting.player_stats(inputs.stats_feed(spark, sf_dir), RUN_DAY)
    return stats.select("player_id", "team_name", "league_name")


def explode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    players = formatting.explode_nested(inputs.roster_feed(spark, sf_dir))
    return players.select(
        "team_id",
        "team_name",
        F.col("player.id").alias("player_id"),
        F.col("player.name").alias("player_name_api"),
    )


def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    formatted = formatting.rosters(inputs.roster_feed(spark, sf_dir), RUN_DAY)
    return formatted.select(*LINK)


def format_player_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.land_envelopes(spark, sf_dir, inputs.player_stats_envelopes)
    envelopes = feeds.read_feed(spark, path, schemas.PLAYER_STATS_ENVELOPE)
    return formatting.player_stats(feeds.require_response(envelopes), RUN_DAY)


def large_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player-stats files read element by element."""
    path = inputs.land_envelopes(spark, sf_dir, inputs.player_stats_envelopes)
    entries = large_feeds.read_entries(spark, path, schemas.PLAYER_STATS_ENTRY)
    return formatting.player_stats_of_entries(entries, RUN_DAY)


def format_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.land_envelopes(spark, sf_dir, inputs.roster_envelopes)
    return formatting.rosters(feeds.read_feed(spark, path, schemas.ROSTER_ENVELOPE), RUN_DAY)


def format_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.market_values(json_schema_scan(spark, sf_dir), RUN_DAY)


# --- scalar functions --------------------------------------------------------------------


def _roster_text(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    return inputs.roster_raw(spark, sf_dir).select(
        *LINK, *[column.alias(name) for name, column in columns.items()]
    )


def name_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roster_text(spark, sf_dir, name_normalized=text.normalize_name(F.col("player_name_api")))


def accent_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = text.fold_accents(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", folded.alias("folded"))


def last_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized = text.normalize_name(F.col("player_name_api"))
    return _roster_text(spark, sf_dir, last_name=text.last_name(normalized))


def first_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    normalized = text.normalize_name(F.col("player_name_api"))
    return _roster_text(spark, sf_dir, first_initial=text.first_initial(normalized))


def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = F.when(F.col("person_id") % 6 != 0, F.col("t2"))
    return inputs.people(spark, sf_dir).select(
        "person_id", text.full_name(F.col("t1"), last).alias("full_name")
    )


def number_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = money.first_number(F.lower(F.trim("market_value_raw")))
    return inputs.values_raw(spark, sf_dir).select(
        "person_id", "market_value_raw", number.alias("number")
    )


def money_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = money.market_value_eur(F.col("market_value_raw"))
    return inputs.values_raw(spark, sf_dir).select(
        "person_id", "market_value_raw", amount.alias("market_value_eur")
    )


def money_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts in the wider grammar, beside the default table's."""
    raw = F.col("raw")
    return inputs.money_texts(spark, sf_dir).select(
        "o_orderkey",
        "raw",
        F.round(money.market_value_by_grammar(raw), 2).alias("by_grammar"),
        money.market_value_eur(raw).alias("by_table"),
    )


def name_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names written with combining marks, normalized as their composed forms."""
    apart = inputs.decomposed(F.lower("player_name_api"))
    return _roster_text(spark, sf_dir, name_normalized=text.normalize_name(apart, compose=True))


def edit_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of each document's roster name to the name it is listed under."""
    listed = inputs.values_raw(spark, sf_dir).where("player_name is not null")
    people = inputs.people(spark, sf_dir).select("person_id", F.concat_ws(" ", "t1", "t2", "t3").alias("name"))
    own, other = text.normalize_name(F.col("name")), text.normalize_name(F.col("player_name"))
    near = text.edit_distance(own, other, 3)
    # The bounded distance is cheaper, and where it finds one, it is the distance.
    return people.join(listed, "person_id").select(
        "person_id",
        "player_name",
        F.when(near >= 0, near).otherwise(text.edit_distance(own, other)).alias("distance"),
        near.alias("distance_to_3"),
    )


def iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = days.day_key(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        days.iso_day(day).alias("iso_day"),
        days.default_run_day(F.col("o_orderdate")).alias("run_day"),
    )


# --- matching ----------------------------------------------------------------------------


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return inputs.roster(spark, sf_dir), inputs.values(spark, sf_dir)


def _cascade(spark: SparkSession, sf_dir: str) -> Cascade:
    return Cascade(*_sides(spark, sf_dir))


def _settled(spark: SparkSession, sf_dir: str) -> Cascade:
    """With level three stored, so that its shuffles are gone before the output rows make theirs."""
    cascade = _cascade(spark, sf_dir)
    cascade.settle()
    return cascade


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(_cascade(spark, sf_dir), RUN_DAY)


def _rounded(final: DataFrame) -> DataFrame:
    return final.withColumn("value_index", F.round("value_index", 6))


def _sides_once(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both sides for a level alone, which reads them once: made in place, not landed before."""
    return inputs.roster_keyed(spark, sf_dir), inputs.values_keyed(spark, sf_dir)


def exact_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.exact_match(*_sides_once(spark, sf_dir)).select(*MATCH)


def residual_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level one's rows, by whether they stop there or go on; one pass over the level."""
    level = matching.exact_match(*_sides_once(spark, sf_dir))
    side = F.when(F.col("market_value_eur").isNotNull(), "matched").otherwise("residual")
    return level.select(*LINK, side.alias("side"))


def lastname_initial_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    roster, values = _sides_once(spark, sf_dir)
    residual = matching.residual(matching.exact_match(roster, values))
    return matching.lastname_initial_match(residual, values).select(*MATCH)


def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest listed name of every player, exact ones included."""
    roster, values = _sides(spark, sf_dir)
    passes = passes_over(roster, values)

    def by_pass(side: DataFrame) -> Iterator[DataFrame]:
        return (in_pass(side, number, passes, "last_name") for number in range(passes))

    named = roster.where("name_normalized is not null")
    names = (part.select("name_normalized").distinct() for part in by_pass(named))
    listed = (matching.listed_names(part) for part in by_pass(values))
    sides = stored_parts(names, "names"), stored_parts(listed, "listed")
    nearest = store_nearest(*sides, passes=passes)
    discard(*sides)
    if passes == 1:
        best = matching.best_candidates(roster, nearest)
    else:
        best = matching.store_best_candidates(roster, nearest, passes)
        discard(nearest)
    return best.select(*LINK, "v_name", "distance", "market_value_eur", "market_value_raw")


CROWDED_LIMIT = 256


def crowded_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest names under few last names, each of which has too many to compare them all."""
    names = matching.with_name_keys(inputs.crowded_names(spark, sf_dir, 7, 1), "player_name")
    listed = matching.listed_names(
        matching.with_name_keys(inputs.crowded_names(spark, sf_dir, 10, 2), "player_name")
    )
    distinct = stored(names.select("name_normalized").distinct(), "names")
    return nearest_names(distinct, stored(listed, "listed"), CROWDED_LIMIT)


def fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _cascade(spark, sf_dir).near
    return near.where(F.col("match_type") == matching.FUZZY).select(*MATCH, "v_name", "distance")


def cascade_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four levels, the last of which lacks the raw text."""
    exact, initial, near = _settled(spark, sf_dir).levels()
    is_fuzzy = F.col("match_type") == matching.FUZZY
    no_match = near.where(~is_fuzzy).drop("market_value_raw")
    return matching.cascade_union(exact, initial, near.where(is_fuzzy), no_match).select(*MATCH)


def match_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir).rows().select(*MATCH, "league_name")


def match_cascade_keep_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settled(spark, sf_dir).rows_keep_unmatched().select(*MATCH, "league_name")


# --- scores and metrics ------------------------------------------------------------------


def value_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_final(spark, sf_dir))


def final_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All published columns of the match rows."""
    return _rounded(scoring.score(_cascade(spark, sf_dir), RUN_DAY))


def top_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(scoring.top_of_cascade(_cascade(spark, sf_dir)))


def match_type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir).match_type_stats()


def cascade_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cascade(spark, sf_dir).level_counts()


def match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = _cascade(spark, sf_dir).match_rate()
    return rates.withColumns(
        {c: F.round(c, 6) for c in ("match_rate", "player_match_rate")}
    )


QUERIES = {
    query.__name__: query
    for query in (
        parquet_scan,
        json_envelope_scan,
        json_schema_scan,
        empty_source_fallback,
        envelope_validate,
        snapshot_write_read,
        multi_date_read,
        snapshot_asof,
        snapshot_read_asof,
        page_assembly,
        dimension_fallback,
        response_triage,
        response_verdict,
        html_rows_extract,
        html_table_extract,
        index_documents,
        bulk_write,
        upsert_latest,
        explode_response,
        nested_paths,
        first_element,
        explode_nested,
        dropna_subset,
        format_player_stats,
        large_feed_scan,
        format_roster,
        format_values,
        name_normalize,
        accent_fold,
        last_name,
        first_initial,
        full_name,
        number_extract,
        money_parse,
        money_grammar,
        name_compose,
        edit_distance,
        iso_date,
        exact_match,
        residual_split,
        lastname_initial_match,
        best_candidate,
        crowded_names,
        fuzzy_match,
        cascade_union,
        match_cascade,
        match_cascade_keep_unmatched,
        value_index,
        final_projection,
        top_players,
        match_type_stats,
        cascade_level_counts,
        match_rate,
    )
}
