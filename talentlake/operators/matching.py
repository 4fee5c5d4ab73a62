"""The levels of name matching: exact name, last name and initial, near name, no match.

``exact_match`` and ``lastname_initial_match`` are single levels as plain left joins. The
rest serves the cascade, which is decided on distinct names, because what a level does to
a row depends on its name alone: a name shared by a third of all rows is one row while it
is being decided. Rows that only multiply a residual on its way down are carried as a
count (``copies``) and come into being at the level that emits them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talentlake.functions import text
from talentlake.operators.nearest import MAX_DISTANCE, value_rank
from talentlake.workspace import discard, in_pass, stored_parts

EXACT, INITIAL, FUZZY, NO_MATCH = "exact", "lastname_initial", "fuzzy", "no_match"

NO_VALUE_RAW = "0"


def with_name_keys(df: DataFrame, name: str, compose: bool = False) -> DataFrame:
    """Add the normalized name and the two keys cut from it."""
    return with_cut_keys(df.withColumn("name_normalized", text.normalize_name(F.col(name), compose)))


def with_cut_keys(df: DataFrame) -> DataFrame:
    """Add the two keys cut from the normalized name."""
    normalized = F.col("name_normalized")
    return df.withColumns(
        {
            "last_name": text.last_name(normalized),
            "first_initial": text.first_initial(normalized),
        }
    )


def exact_match(roster: DataFrame, values: DataFrame) -> DataFrame:
    """Level one alone: left join on the normalized name, all right rows kept."""
    return _level(roster, values, ["name_normalized"], EXACT)


def lastname_initial_match(residual: DataFrame, values: DataFrame) -> DataFrame:
    """Level two alone: left join on last name and first initial."""
    return _level(residual, values, ["last_name", "first_initial"], INITIAL)


def _level(left: DataFrame, values: DataFrame, keys: list[str], label: str) -> DataFrame:
    right = values.select(*keys, "market_value_eur", "market_value_raw")
    found = F.col("market_value_eur").isNotNull()
    return left.join(right, keys, "left").withColumn("match_type", F.when(found, label))


def matched(level: DataFrame) -> DataFrame:
    return level.where("match_type is not null")


def residual(level: DataFrame) -> DataFrame:
    """The rows that go on to the next level, without this level's columns."""
    return level.where("match_type is null").drop(
        "match_type", "market_value_eur", "market_value_raw"
    )


def listed_names(values: DataFrame) -> DataFrame:
    """One row per normalized name of the values side: valued, NULL-valued and positive
    rows, the highest value, and the row that stands for the name when it is the nearest."""
    value = F.col("market_value_eur")
    name = F.col("v_name")
    return (
        values.where("name_normalized is not null")
        .groupBy(F.col("name_normalized").alias("v_name"))
        .agg(
            F.count(value).alias("hits"),
            F.count_if(value.isNull()).alias("blanks"),
            F.count_if(value > 0).alias("positives"),
            F.max(value).alias("top"),
            F.min(value_rank(value, F.col("market_value_raw"))).alias("value"),
        )
        .withColumns(
            {"last_name": text.last_name(name), "first_initial": text.first_initial(name)}
        )
    )


def listed_initials(listed: DataFrame) -> DataFrame:
    """The counts of ``listed_names`` by last name and first initial."""
    return listed.groupBy("last_name", "first_initial").agg(
        *[F.sum(c).alias(c) for c in ("hits", "blanks", "positives")], F.max("top").alias("top")
    )


def name_decisions(roster: DataFrame, listed: DataFrame) -> DataFrame:
    """One row per distinct roster name with what levels one and two do to its rows.

    ``listings`` counts the roster rows; each meets ``hits_1`` valued rows at level one and
    leaves it as ``copies_1`` residual rows, each of which meets ``hits_2`` at level two and
    leaves that as ``copies_2``.
    """
    name = F.col("name_normalized")
    names = (
        roster.where("name_normalized is not null")
        .groupBy("name_normalized")
        .agg(F.count("*").alias("listings"))
    )
    by_name = _outcome(listed, 1).select(F.col("v_name").alias("name_normalized"), *_columns(1))
    # The key joined on differs from the keys grouped by, so that this side is shuffled for
    # the join alone; only then can adaptive execution split a key that is hot among names.
    by_initial = _outcome(listed_initials(listed), 2).select(
        F.concat_ws(" ", "first_initial", "last_name").alias("initial_key"), *_columns(2)
    )
    # A name that meets nothing keeps its one row.
    unmet = {"hits": 0, "copies": 1, "positives": 0}
    return (
        names.join(by_name, "name_normalized", "left")
        .withColumns(
            {"last_name": text.last_name(name), "first_initial": text.first_initial(name)}
        )
        .withColumn("initial_key", F.concat_ws(" ", "first_initial", "last_name"))
        .join(by_initial, "initial_key", "left")
        .select(
            "name_normalized",
            "last_name",
            "first_initial",
            "listings",
            *[
                F.coalesce(f"{column}_{level}", F.lit(rows).cast("bigint")).alias(f"{column}_{level}")
                for level in (1, 2)
                for column, rows in unmet.items()
            ],
            "top_1",
            "top_2",
        )
    )


def _columns(level: int) -> list[str]:
    return [f"{c}_{level}" for c in ("hits", "copies", "positives", "top")]


def _outcome(counts: DataFrame, level: int) -> DataFrame:
    """A left join leaves one residual row per NULL value it meets: ``blanks`` are copies."""
    counts = counts.withColumnRenamed("blanks", "copies")
    return counts.withColumnsRenamed(
        {c: f"{c}_{level}" for c in ("hits", "copies", "positives", "top")}
    )


def exact_rows(roster: DataFrame, values: DataFrame) -> DataFrame:
    """Level one's matches."""
    valued = values.where("market_value_eur is not null").select(
        "name_normalized", "market_value_eur", "market_value_raw"
    )
    return roster.join(valued, "name_normalized").withColumn("match_type", F.lit(EXACT))


def initial_rows(roster: DataFrame, values: DataFrame, decisions: DataFrame) -> DataFrame:
    """Level two's matches. What a row meets grows with the values, so all that is shuffled is
    the rows and the values; their pairs come last and stay where they are made."""
    valued = values.where("market_value_eur is not null").select(
        "last_name", "first_initial", "market_value_eur", "market_value_raw"
    )
    # The keys come from the names, so that the rows are shuffled as level one shuffles them, once.
    linked = decisions.where((F.col("copies_1") > 0) & (F.col("hits_2") > 0)).select(
        "name_normalized", "last_name", "first_initial", "copies_1"
    )
    rows = roster.drop("last_name", "first_initial").join(linked, "name_normalized").join(valued, ["last_name", "first_initial"])
    return _repeated(rows, "copies_1").withColumn("match_type", F.lit(INITIAL))


def _repeated(rows: DataFrame, copies: str, step: int = 10_000) -> DataFrame:
    """Every row as often as ``copies`` (at least 1) says, that column dropped.

    In two steps, so that a high count does not become one long array.
    """
    done = F.col("round") * step
    rounds = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(copies) - 1) / step))
    once = F.sequence(F.lit(1).cast("bigint"), F.least(F.col(copies) - done, F.lit(step)))
    return (
        rows.withColumn("round", F.explode(rounds))
        .withColumn("copy", F.explode(once))
        .drop("round", "copy", copies)
    )


def best_candidates(roster: DataFrame, nearest: DataFrame) -> DataFrame:
    """One row per player: its roster row whose nearest name is the closest.

    A row without any name to compare with has a NULL distance, which sorts first, and
    thereby drops its player; this includes rows that have no name at all. Rows with none near
    enough come after all others and are dropped where they come first, so they need no place.
    """
    return _winners(_first_of_player(_candidates(roster, nearest)), roster)


def store_best_candidates(roster: DataFrame, nearest: DataFrame, passes: int) -> DataFrame:
    """``best_candidates`` as a table. A player's rows may have several names, so that a pass over
    some names leaves the first of the player's rows there, and passes over players choose of these."""
    nearest = nearest.withColumn("last_name", text.last_name(F.col("name_normalized")))

    def by_name(number: int) -> DataFrame:
        rows, names = (in_pass(side, number, passes, "last_name") for side in (roster, nearest))
        return _first_of_player(_candidates(rows, names.drop("last_name")))

    first = stored_parts((by_name(n) for n in range(passes)), "candidates")
    by_player = (_first_of_player(in_pass(first, n, passes, "player_id")) for n in range(passes))
    best = stored_parts((_winners(rows, roster) for rows in by_player), "best")
    discard(first)
    return best


# Keys that are cut from the name. Rows are shuffled without them; they are cut again from what is left.
CUT_KEYS = {"last_name": text.last_name, "first_initial": text.first_initial}


def _candidates(roster: DataFrame, nearest: DataFrame) -> DataFrame:
    near = nearest.where(F.col("distance").isNull() | (F.col("distance") <= MAX_DISTANCE))
    rows = roster.drop(*CUT_KEYS)
    nameless = rows.where("name_normalized is null")
    return rows.join(near, "name_normalized").unionByName(nameless, allowMissingColumns=True)


def _first_of_player(candidates: DataFrame) -> DataFrame:
    order = [
        F.asc_nulls_first("distance"),
        F.asc_nulls_first("v_name"),
        F.desc_nulls_last("market_value_eur"),
        F.asc_nulls_last("market_value_raw"),
        F.asc("team_name"),
        F.asc("player_name_api"),
    ]
    by_player = Window.partitionBy("player_id").orderBy(*order)
    ranked = candidates.withColumn("candidate_rank", F.row_number().over(by_player))
    return ranked.where("candidate_rank = 1").drop("candidate_rank")


def _winners(first: DataFrame, roster: DataFrame) -> DataFrame:
    return with_keys_again(first.where(F.col("distance") <= MAX_DISTANCE), roster)


def with_keys_again(rows: DataFrame, roster: DataFrame) -> DataFrame:
    """Cut the keys from the names that ``roster`` has."""
    name = F.col("name_normalized")
    return rows.withColumns({key: cut(name) for key, cut in CUT_KEYS.items() if key in roster.columns})


def near_rows(roster: DataFrame, best: DataFrame) -> DataFrame:
    """Level three's winners, of ``best_candidates``: ``fuzzy``, or ``no_match`` where the nearest
    has no value."""
    found = F.col("market_value_eur").isNotNull()
    return best.select(
        *roster.columns,
        "v_name",
        "distance",
        F.coalesce("market_value_eur", F.lit(0.0)).alias("market_value_eur"),
        F.when(found, F.col("market_value_raw")).otherwise(NO_VALUE_RAW).alias("market_value_raw"),
        F.when(found, FUZZY).otherwise(NO_MATCH).alias("match_type"),
    )


def cascade_union(*levels: DataFrame) -> DataFrame:
    """UNION ALL by name; a column that a level lacks is NULL there."""
    union = levels[0]
    for level in levels[1:]:
        union = union.unionByName(level, allowMissingColumns=True)
    return union
