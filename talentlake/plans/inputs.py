"""Matching inputs derived from ``documents``: one player, and what is listed of it, per
three words of the whole texts. Spelling, spacing, team and money text vary with the player's
number, so that every level of the cascade and every money form occurs; all words take part."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talentlake.functions.days import day_key
from talentlake.functions.text import FOLD_FROM
from talentlake.operators import formatting
from talentlake.operators.matching import with_cut_keys, with_name_keys
from talentlake.sources.snapshots import DAY
from talentlake.workspace import fresh_path, shuffles_dropped

RUN_DAY = "20240101"
SOURCE_URL = "https://values.example/listing"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Numbers of players kept for a document (texts of up to 3,000,000 words).
PLAYERS_PER_DOCUMENT = 1_000_000


# Bytes of documents that a task finds names in.
BYTES_PER_TASK = 2 << 20


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names found in the documents. The texts, far smaller than the players made of them, are
    dealt evenly first, since a file may be one task and its players are worked on in place."""
    tasks = max(spark.sparkContext.defaultParallelism, _content(spark, sf_dir).getLength() // BYTES_PER_TASK)
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return _people(documents.repartition(tasks, "doc_id", F.xxhash64("text")))


def _people(documents: DataFrame, *kept: str) -> DataFrame:
    """Name words, three by three, the last ones of a text perhaps fewer; letters of the
    player's number make the last one selective, yet common words share them."""
    too_long = F.raise_error(F.lit("a text has more names than there are numbers for"))
    place = F.when(F.col("place") < PLAYERS_PER_DOCUMENT, F.col("place")).otherwise(too_long.cast("int"))
    person = F.col("doc_id") * PLAYERS_PER_DOCUMENT + place
    # DuckDB's levenshtein counts bytes, hence the two-letter form of the sharp s.
    spaced = F.regexp_replace(F.replace("text", F.lit("ß"), F.lit("ss")), "[ \n]+", " ")
    groups = F.regexp_extract_all(spaced, F.lit("[^ ]+(?: [^ ]+){0,2}"), 0)

    def word(i: int) -> Column:
        return F.split_part("words", F.lit(" "), F.lit(i))

    def letter(step: int) -> Column:
        return F.char(F.lit(97) + F.floor(F.col("person_id") / step) % 26)

    return (
        documents.select(*kept, "doc_id", "source", "lang", F.posexplode(groups).alias("place", "words"))
        .select(*kept, person.alias("person_id"), "source", "lang", "words")
        .select(
            *kept,
            "person_id",
            "source",
            "lang",
            word(1).alias("t1"),
            word(2).alias("t2"),
            F.concat(word(3), letter(1), letter(26), letter(676)).alias("t3"),
        )
    )


def roster_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roster(people(spark, sf_dir))


def _roster(people: DataFrame, *kept: str) -> DataFrame:
    """Squad listings: some names abbreviated, some players listed by a second team."""
    person = F.col("person_id")
    full = F.concat_ws(" ", "t1", F.concat_ws("-", "t2", "t3"))
    short = F.concat(F.left("t1", F.lit(1)), F.lit(". "), F.concat_ws("-", "t2", "t3"))
    own = F.struct(
        F.when(person % 4 == 1, short).otherwise(full).alias("player_name_api"),
        F.col("source").alias("team_name"),
    )
    loan = F.struct(full.alias("player_name_api"), F.lit("loan").alias("team_name"))
    listings = F.when((person % 20).isin(1, 8, 16), F.array(own, loan)).otherwise(F.array(own))
    return people.select(
        *kept,
        person.alias("player_id"),
        F.inline(listings),
        F.col("lang").alias("league_name"),
        F.lit(RUN_DAY).alias("extraction_date"),
    )


def values_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _values(people(spark, sf_dir))


def _values(people: DataFrame, *kept: str) -> DataFrame:
    """Market values: names respelled, some beyond a match, some listed again with an extra letter."""
    person = F.col("person_id")
    tail = F.concat_ws(" ", "t2", "t3")
    name = (
        F.when(person % 3 == 0, F.concat_ws(" ", F.concat(F.lit("zzqx"), "t1"), tail))
        .when(person % 5 == 1, F.concat_ws(" ", F.substr("t1", F.lit(2)), tail))
        .when(person % 5 == 2, F.upper(F.concat_ws(" ", "t1", tail)))
        .otherwise(F.concat(F.lit("  "), "t1", F.lit("  "), tail))
    )
    amount = (person % 90 + 1).cast("string")
    raw = (
        F.when(person % 7 == 0, "k. A.")
        .when(person % 7 == 1, F.concat(amount, F.lit(" K €")))
        .when(person % 7 == 2, F.concat(amount, F.lit(","), (person % 10).cast("string"), F.lit("0 mio. €")))
        .when(person % 7 == 3, F.concat(F.lit("€"), amount, F.lit(".5m")))
        .when(person % 7 == 4, "-")
        .when(person % 7 == 6, F.concat(amount, F.lit(" mille €")))
    )
    listed = F.struct(name.alias("player_name"), raw.alias("market_value_raw"))
    again = F.struct(
        F.concat_ws(" ", F.concat("t1", F.lit("x")), tail).alias("player_name"),
        F.lit("2,50 mio. €").alias("market_value_raw"),
    )
    listings = F.when(person % 10 == 3, F.array(listed, again)).otherwise(F.array(listed))
    return people.select(*kept, person, F.inline(listings), F.lit(SOURCE_URL).alias("scraped_url"))


def values_formatted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatting.market_values(values_raw(spark, sf_dir), RUN_DAY)


# Where this application landed what it derived, by the state of the table it came from.
_landed: dict[tuple, str] = {}


def _content(spark: SparkSession, sf_dir: str):
    """Files and bytes of the documents."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/documents.parquet")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path)


def _source_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Changes when the documents do: their files, bytes and time."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/documents.parquet")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    content = _content(spark, sf_dir)
    changed = system.getFileStatus(path).getModificationTime()
    return spark.sparkContext.applicationId, sf_dir, content.getFileCount(), content.getLength(), changed


def landed_path(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Where ``write`` put what it derives from the documents, which it does once."""
    key = (*_source_state(spark, sf_dir), name)
    if key in _landed:
        path = spark._jvm.org.apache.hadoop.fs.Path(_landed[key])
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return _landed[key]
    path = fresh_path(spark, name)
    with shuffles_dropped(spark):
        write(path)
    _landed[key] = path
    return path


def landed(
    spark: SparkSession, sf_dir: str, derive: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """``derive``'s table as the lake's formatted zone holds it: written once, then read."""
    derived = derive(spark, sf_dir)
    path = landed_path(spark, sf_dir, derive.__name__, lambda to: derived.write.parquet(to, compression="zstd"))
    return spark.read.schema(derived.schema).parquet(path)


def roster_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_name_keys(roster_raw(spark, sf_dir), "player_name_api")


def values_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = with_name_keys(values_formatted(spark, sf_dir), "player_name")
    return keyed.select("name_normalized", "last_name", "first_initial", "market_value_eur", "market_value_raw")


# The keys cut from a name are cut again from what was landed.
def roster_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster_keyed(spark, sf_dir).drop("last_name", "first_initial")


def values_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return values_keyed(spark, sf_dir).drop("last_name", "first_initial")


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster side of the cascade, with its name keys; landed, as it is read more than once."""
    return with_cut_keys(landed(spark, sf_dir, roster_named))


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values side of the cascade, with its name keys; landed, as it is read more than once."""
    return with_cut_keys(landed(spark, sf_dir, values_named))


def _letters(number: Column) -> Column:
    return F.translate(number.cast("string"), "0123456789", "abcdefghij")


def crowded_names(spark: SparkSession, sf_dir: str, factor: int, start: int) -> DataFrame:
    """Two names of every customer under a market segment, of which there are few: a short one,
    letters of the key times ``factor``, and a long one, a code from place ``start`` on."""
    short = _letters(F.col("c_custkey") * factor)
    code = F.translate(F.substring(F.md5(F.col("c_name").cast("binary")), start, 14), "0123456789", "ghijklmnop")
    return table(spark, sf_dir, "customer").select(
        F.explode(F.array(short, code)).alias("given"),
        F.lower("c_mktsegment").alias("family"),
        F.col("c_acctbal").alias("market_value_eur"),
        F.col("c_name").alias("market_value_raw"),
    ).withColumn("player_name", F.concat_ws(" ", "given", "family"))


# A landed feed file holds up to 2,000 players of each of 64 documents; that bounds what one
# file gathers, whatever the data size.
PLAYERS_PER_FILE = 2000
DOCUMENTS_PER_FILE = 64


def _shard(person: str = "player_id") -> Column:
    documents = F.floor(F.col(person) / (DOCUMENTS_PER_FILE * PLAYERS_PER_DOCUMENT))
    part = F.floor(F.col(person) % PLAYERS_PER_DOCUMENT / PLAYERS_PER_FILE)
    return (documents * (PLAYERS_PER_DOCUMENT // PLAYERS_PER_FILE) + part).cast("int").alias("shard")


# Bytes of the documents whose players one task gathers into files, so that they fit in its memory.
BYTES_PER_GATHERING = 2 << 20


def _people_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The names found in the documents, and ``block``. The texts are dealt by it, which are far
    smaller than the players made of them; what is then grouped by block and file stays in place.
    The files of negative numbers overlap, so these are one block."""
    block = F.when(F.col("doc_id") < 0, F.lit(-1).cast("bigint")).otherwise(F.floor(F.col("doc_id") / DOCUMENTS_PER_FILE))
    size = _content(spark, sf_dir).getLength()
    tasks = max(spark.sparkContext.defaultParallelism, size // BYTES_PER_GATHERING)
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text", block.alias("block"))
    return _people(documents.repartition(tasks, "block"), "block")


def player_stats_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player-stats envelopes; every player has no, one or two statistics elements."""
    player_id, name = F.col("player_id"), F.col("player_name_api")
    first = F.substring_index(name, " ", 1)
    player = F.struct(
        player_id.alias("id"),
        name.alias("name"),
        first.alias("firstname"),
        F.when(player_id % 6 != 0, F.substring_index(name, " ", -1)).alias("lastname"),
    )

    def statistic(team: Column) -> Column:
        return F.struct(
            F.struct(team.alias("name")).alias("team"),
            F.struct(F.col("league_name").alias("name")).alias("league"),
        )

    one = F.array(statistic(F.col("team_name")))
    statistics = (
        F.when(player_id % 11 == 0, F.slice(one, 1, 0))
        .when(player_id % 3 == 1, F.concat(one, F.array(statistic(F.lit("former")))))
        .otherwise(one)
    )
    entry = F.struct(player.alias("player"), statistics.alias("statistics"))
    error = F.struct(
        F.col("shard").cast("bigint").alias("team_id"),
        F.lit("loan").alias("team_name"),
        F.lit(2).alias("page"),
        F.lit("timeout").alias("error"),
    )
    return (
        _roster(_people_by_file(spark, sf_dir), "block")
        .groupBy("block", _shard())
        .agg(F.collect_list(entry).alias("response"))
        .select(
            "shard",
            F.lit("players_by_teams").alias("get"),
            F.struct(F.lit(61).alias("league"), F.lit(2024).alias("season")).alias("parameters"),
            F.size("response").alias("results"),
            F.array(error).alias("errors"),
            "response",
        )
    )


def roster_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster envelopes: players in team blocks, some without a name."""
    player_id = F.col("player_id")
    name = F.when(player_id % 13 != 0, F.col("player_name_api"))
    player = F.struct(player_id.alias("id"), name.alias("name"))
    team = F.struct(F.length("team_name").cast("bigint").alias("id"), F.col("team_name").alias("name"))
    block = F.struct(team.alias("team"), F.col("players"))
    return (
        _roster(_people_by_file(spark, sf_dir), "block")
        .groupBy("block", _shard(), "team_name")
        .agg(F.collect_list(player).alias("players"))
        .groupBy("block", "shard")
        .agg(F.collect_list(block).alias("response"))
        .select(
            "shard",
            F.lit("players/squads").alias("get"),
            F.lit(61).alias("league"),
            F.lit(2024).alias("season"),
            F.lit(RUN_DAY).alias("date"),
            F.size("response").alias("results"),
            "response",
        )
    )


def stats_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The player-stats envelopes as landed."""
    return landed(spark, sf_dir, player_stats_envelopes)


def roster_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster envelopes as landed."""
    return landed(spark, sf_dir, roster_envelopes)


def land_envelopes(
    spark: SparkSession, sf_dir: str, envelopes: Callable[[SparkSession, str], DataFrame]
) -> str:
    """Write one JSON object per compressed file; returns the glob of the day's files."""

    def write(path: str) -> None:
        envelopes(spark, sf_dir).write.partitionBy("shard").json(f"{path}/{RUN_DAY}", compression="gzip")

    return f"{landed_path(spark, sf_dir, f"{envelopes.__name__}_json", write)}/{RUN_DAY}/*/*.json.gz"


def land_values(spark: SparkSession, sf_dir: str) -> str:
    """Write the raw market values as one JSON array per compressed file; returns the files' glob."""
    row = F.struct("player_name", "market_value_raw", "scraped_url")

    def write(path: str) -> None:
        (
            _values(_people_by_file(spark, sf_dir), "block")
            .groupBy("block", _shard("person_id"))
            .agg(F.to_json(F.collect_list(row)).alias("value"))
            .drop("block")
            .write.partitionBy("shard")
            .text(f"{path}/{RUN_DAY}", compression="gzip")
        )

    return f"{landed_path(spark, sf_dir, 'market_values', write)}/{RUN_DAY}/*/*.txt.gz"


def order_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages of at most 50 orders by priority; some pages failed on the way."""
    page = F.floor(F.col("o_orderkey") / 50)
    open_order = F.col("o_orderstatus") == "P"
    entry = F.struct(
        F.struct(
            F.when(~open_order, F.col("o_orderkey")).alias("id"),
            F.col("o_orderstatus").alias("name"),
        ).alias("team"),
    )
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("team_name"), page.alias("page"))
        .agg(F.collect_list(entry).alias("response"))
        .select(
            F.substring("team_name", 1, 1).cast("bigint").alias("team_id"),
            "team_name",
            "page",
            F.when(F.col("page") % 7 == 0, "timeout").alias("error"),
            F.when(F.col("page") % 7 != 0, F.col("response")).alias("response"),
        )
    )


def money_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices spelled in seven ways, by the order's number."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    whole, f = F.floor(cents / 100), F.lpad((cents % 100).cast("string"), 2, "0")
    a, b = F.floor(whole / 1000).cast("string"), F.lpad((whole % 1000).cast("string"), 3, "0")
    styles = [
        F.concat(a, F.lit("."), b, F.lit(","), f, F.lit(" €")),
        F.concat(F.lit("EUR "), a, F.lit(","), b, F.lit("."), f),
        F.concat(a, F.lit(" "), b, F.lit(" K")),
        F.concat(a, F.lit(","), F.right(b, F.lit(1)), F.lit(" Mrd. €")),
        F.concat(a, F.lit("."), b, F.lit(" mln")),
        F.concat(a, F.lit("\u00a0"), b, F.lit(" €")),
        F.concat(F.lit("CHF "), a, F.lit("'"), b),
    ]
    style = F.get(F.array(*styles), (F.col("o_orderkey") % len(styles)).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", style.alias("raw"))


def decomposed(letters: Column) -> Column:
    """Text whose folding letters are written as a letter and a combining mark."""
    apart = letters
    for one in FOLD_FROM:
        apart = F.replace(apart, F.lit(one), F.lit(unicodedata.normalize("NFD", one)))
    return F.when(letters.rlike(f"[{FOLD_FROM}]"), apart).otherwise(letters)


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed responses: a user's events of a day are the attempts for one team."""
    status = F.element_at(
        F.array(*[F.lit(s) for s in (200, 429, 500, 404, 200, 502, 503, 504)]),
        (F.col("event_id") % 8 + 1).cast("int"),
    )
    message = F.when((F.col("event_type") == "error") & (F.col("user_id") % 7 == 0), "Request limit").otherwise("")
    body = F.to_json(F.struct(F.struct(message.alias("requests")).alias("errors")))
    return table(spark, sf_dir, "events").select(
        day_key(F.col("ts")).alias("day"),
        F.col("user_id").alias("team_id"),
        F.col("event_id").alias("attempt"),
        status.alias("status"),
        body.alias("body"),
    )


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the snapshot day they belong to."""
    return table(spark, sf_dir, "events").withColumn(DAY, day_key(F.col("ts")))
