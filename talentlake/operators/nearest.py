"""Nearest name inside a last-name block, by bounded edit distance.

Two names of one block end in the same last name, and a common suffix does not change an
edit distance, so only the parts before it are compared. Both sides are cut to distinct
names first. A block with few targets is joined directly. A block with more would cost
targets x names comparisons, so there names meet through signatures instead:

* short given parts through *edit patterns*: the texts left after at most k characters are
  deleted or blanked. Two texts are within k edits exactly if they share a pattern that
  costs at most k in all, and the targets of one pattern collapse to the single best one
  before the join, so no pair is ever emitted twice or in vain;
* long ones through *segments* (Pass-Join, Li et al., VLDB 2011): a target cut in k + 1
  segments leaves at least one of them intact, near its old position, under k edits.

The sizes of the blocks are stored first, since they decide which routes a run needs and into
how many partitions the names of crowded blocks are dealt. Signatures are joined by a key of
their own, which neither side is partitioned by before, so adaptive execution can split one that
many names share. Every route is exact; together they give the same winner as comparing all
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.functions import text
from talentlake.workspace import discard, in_pass, stored, stored_parts

MAX_DISTANCE = 3
# Distinct targets of a last name up to which its block is compared directly; about where
# comparing a name with all of them costs as much as its edit patterns.
BLOCK_LIMIT = 4096
# Names of one last name that are compared with its targets in one slice.
SLICE_NAMES = 10_000
# Given parts up to this length use edit patterns (about 1,200 for a text of ten).
PATTERN_LENGTH = 10
# Signatures that a partition of crowded names should grow to, and about how many a name has.
PARTITION_SIGNATURES = 4_000_000
NAME_SIGNATURES = 1_000
# Stands for a blanked character; a code point that Unicode never assigns.
BLANK = "\uffff"


def value_rank(value: Column, raw: Column) -> Column:
    """Struct whose minimum is the highest value (NULL last), then the smallest raw text."""
    return F.struct(
        value.isNull().alias("no_value"),
        (-value).alias("minus_value"),
        raw.isNull().alias("no_raw"),
        raw.alias("raw"),
    )


def nearest_names(
    names: DataFrame,
    listed: DataFrame,
    block_limit: int = BLOCK_LIMIT,
    slice_names: int = SLICE_NAMES,
    pattern_length: int = PATTERN_LENGTH,
) -> DataFrame:
    """The best target of every name, as one row per name.

    ``names`` holds distinct ``name_normalized``; ``listed`` one row per target ``v_name``
    with its ``last_name`` and best ``value``. Both are read more than once, so they should
    be tables. ``distance`` is NULL when no target has the last name, ``MAX_DISTANCE + 1``
    when none is near enough, and otherwise that of the first target by distance, name,
    value (highest first, NULL last) and raw text.
    """
    left, targets = _sides(names, listed)
    blocks = stored(_blocks(left, targets, slice_names), "blocks")
    return _nearest(left, targets, blocks, block_limit, pattern_length)


def store_nearest(names: DataFrame, listed: DataFrame, block_limit: int = BLOCK_LIMIT, passes: int = 1) -> DataFrame:
    """``nearest_names`` as a table; what was stored on the way to it is deleted. A pass takes the
    blocks of its last names."""
    sides = _sides(names, listed)

    def parts() -> Iterator[DataFrame]:
        for number in range(passes):
            left, targets = (in_pass(side, number, passes, "last_name") for side in sides)
            blocks = stored(_blocks(left, targets, SLICE_NAMES), "blocks")
            yield _nearest(left, targets, blocks, block_limit, PATTERN_LENGTH)
            discard(blocks)

    return stored_parts(parts(), "nearest")


def _sides(names: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    name, target = F.col("name_normalized"), F.col("v_name")
    left = names.select(
        name, text.last_name(name).alias("last_name"), text.given_part(name).alias("given")
    )
    return left, listed.select("last_name", text.given_part(target).alias("v_given"), target, "value")


def _nearest(left: DataFrame, targets: DataFrame, blocks: DataFrame, block_limit: int, pattern_length: int) -> DataFrame:
    probes = left.join(blocks.drop("names"), "last_name")

    big = F.col("targets") > block_limit
    best = _by_block(probes.where(~big), targets, blocks.where(~big))
    crowded = blocks.where(big)
    sizes = crowded.agg(F.sum("names"), F.sum("targets")).first()
    if sizes[0]:
        crowded_probes = probes.where(big)
        crowded_targets = targets.join(crowded.select("last_name"), "last_name")
        sides = _spread(crowded_probes, "name_normalized", sizes[0]), _spread(crowded_targets, "v_name", sizes[1])
        found = [
            _start(crowded_probes),
            _by_patterns(*sides, pattern_length),
            _by_segments(*sides, pattern_length),
        ]
        nearest = F.min(F.struct("distance", "v_name", "value")).alias("best")
        best = best.unionByName(
            reduce(DataFrame.unionByName, found).groupBy("name_normalized").agg(nearest).select("name_normalized", "best.*")
        )
    return best.select(
        "name_normalized",
        "distance",
        "v_name",
        (-F.col("value.minus_value")).alias("market_value_eur"),
        F.col("value.raw").alias("market_value_raw"),
    )


def _blocks(left: DataFrame, targets: DataFrame, slice_names: int) -> DataFrame:
    """Per last name to look up: its targets, and the slices its names are dealt into."""
    looked_up = left.groupBy("last_name").agg(F.count("*").alias("names"))
    offered = targets.groupBy("last_name").agg(F.count("*").alias("targets"))
    return looked_up.join(offered, "last_name", "left").select(
        "last_name",
        "names",
        F.coalesce("targets", F.lit(0).cast("bigint")).alias("targets"),
        F.ceil(F.col("names") / slice_names).alias("slices"),
    )


def _spread(names: DataFrame, column: str, size: int) -> DataFrame:
    """So many names dealt out evenly. Joined by last name they sit together, and by their bytes
    they would seem too few to split, yet each is about to become hundreds of signatures."""
    at_least = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return names.repartition(max(at_least, size * NAME_SIGNATURES // PARTITION_SIGNATURES), column)


def _signature(*parts: str) -> Column:
    """One key of several columns. Joined by it, a side that was aggregated by the columns is
    shuffled again, and only then can a hot signature be split."""
    return F.concat_ws("\x00", *parts).alias("signature")


def _start(probes: DataFrame) -> DataFrame:
    """A row for every crowded name, which any real candidate beats."""
    return probes.select(
        "name_normalized",
        F.lit(MAX_DISTANCE + 1).alias("distance"),
        F.lit(None).cast("string").alias("v_name"),
        F.lit(None)
        .cast("struct<no_value: boolean, minus_value: double, no_raw: boolean, raw: string>")
        .alias("value"),
    )


def _by_block(probes: DataFrame, targets: DataFrame, blocks: DataFrame) -> DataFrame:
    """The best target of every name by all pairs of its block, which has few targets; its names
    may be many, so they are dealt into slices, and each slice gets a copy of those targets. All
    pairs of a name meet in one slice, so the best is found there, without another shuffle."""
    slice_of = F.pmod(F.xxhash64("name_normalized"), F.col("slices"))
    copies = blocks.where("targets > 0").select(
        "last_name", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("v_slice")
    )
    offered = targets.join(copies, "last_name").withColumnRenamed("last_name", "v_last_name")
    distance = text.edit_distance(F.col("given"), F.col("v_given"), MAX_DISTANCE)
    # Measured by the join, so that only near pairs come out of it.
    near = _lengths_near() & (distance >= 0)
    together = (F.col("last_name") == F.col("v_last_name")) & (F.col("slice") == F.col("v_slice"))
    candidate = F.when(F.col("distance").isNotNull(), F.struct("distance", "v_name", "value"))
    # Without targets the distance stays NULL.
    none_near = F.when(F.col("targets") > 0, F.lit(MAX_DISTANCE + 1))
    return (
        probes.withColumn("slice", slice_of)
        .join(offered, together & near, "left")
        .withColumn("distance", distance)
        .groupBy("last_name", "slice", "name_normalized", "targets")
        .agg(F.min(candidate).alias("best"))
        .select("name_normalized", F.coalesce("best.distance", none_near).alias("distance"), "best.v_name", "best.value")
    )


def _lengths_near() -> Column:
    return F.abs(F.length("given") - F.length("v_given")) <= MAX_DISTANCE


def _measured(pairs: DataFrame) -> DataFrame:
    distance = text.edit_distance(F.col("given"), F.col("v_given"), MAX_DISTANCE)
    return pairs.select(
        "name_normalized", distance.alias("distance"), "v_name", "value"
    ).where(F.col("distance") >= 0)


def edit_patterns(source: Column, edits: int = MAX_DISTANCE) -> Column:
    """All texts left when at most ``edits`` characters are deleted or blanked.

    Grown character by character, each of which is kept, deleted or blanked.
    """

    def grow(states: Column, position: Column) -> Column:
        character = F.substr(source, position, F.lit(1))

        def choices(state: Column) -> Column:
            kept, used = state["kept"], (state["used"] + 1).alias("used")
            keep = F.struct(F.concat(kept, character).alias("kept"), state["used"].alias("used"))
            delete = F.struct(kept.alias("kept"), used)
            blank = F.struct(F.concat(kept, F.lit(BLANK)).alias("kept"), used)
            return F.when(state["used"] < edits, F.array(keep, delete, blank)).otherwise(
                F.array(keep)
            )

        return F.flatten(F.transform(states, choices))

    start = F.array(F.struct(F.lit("").alias("kept"), F.lit(0).alias("used")))
    # A sequence from 1 to 0 would count down.
    positions = F.when(F.length(source) > 0, F.sequence(F.lit(1), F.length(source))).otherwise(
        F.array().cast("array<int>")
    )
    states = F.aggregate(positions, start, grow)
    return F.array_distinct(F.transform(states, lambda state: state["kept"]))


def _by_patterns(probes: DataFrame, targets: DataFrame, pattern_length: int) -> DataFrame:
    """Of every name the best target that shares a pattern. A pattern's row holds what the
    distance and the order need; the value is looked up once the best target is known.

    Sizes are guessed before the patterns are made, hundreds of each name, so that a side that
    is far too large would seem small enough to be sent whole to the driver: hence the hint."""
    pattern = F.col("pattern")
    blanks = F.length(pattern) - F.length(F.replace(pattern, F.lit(BLANK), F.lit("")))
    # A target of a pattern costs its deletions only, so the shortest one is the nearest.
    nearest = F.min(F.struct(F.length("v_given").alias("v_length"), "v_name"))
    index = (
        targets.where(F.length("v_given") <= pattern_length)
        .select("last_name", "v_given", "v_name", F.explode(edit_patterns(F.col("v_given"))).alias("pattern"))
        .groupBy("last_name", "pattern")
        .agg(nearest.alias("target"))
        .select(_signature("last_name", "pattern"), "target.*")
    )
    # Deletions on both sides are the lengths lost; blanks stand for substitutions.
    cost = F.length("given") - 2 * F.length(pattern) + blanks
    best = (
        probes.where(F.length("given") <= pattern_length)
        .withColumn("pattern", F.explode(edit_patterns(F.col("given"))))
        .select("name_normalized", cost.alias("cost"), _signature("last_name", "pattern"))
        .join(index.hint("merge"), "signature")
        .select("name_normalized", (F.col("cost") + F.col("v_length")).alias("distance"), "v_name")
        .where(F.col("distance") <= MAX_DISTANCE)
        .groupBy("name_normalized")
        .agg(F.min(F.struct("distance", "v_name")).alias("best"))
        .select("name_normalized", "best.*")
    )
    return best.join(targets.select("v_name", "value"), "v_name").select("name_normalized", "distance", "v_name", "value")


def _by_segments(probes: DataFrame, targets: DataFrame, pattern_length: int) -> DataFrame:
    """Pairs in which at least one given part is longer than ``pattern_length``; the hint as above."""
    shortest = max(0, pattern_length + 1 - MAX_DISTANCE)
    numbers = F.sequence(F.lit(0), F.lit(MAX_DISTANCE))
    number, v_length = F.col("segment"), F.col("v_length")
    size = F.floor(v_length / (MAX_DISTANCE + 1)).cast("int")
    plain = MAX_DISTANCE + 1 - v_length % (MAX_DISTANCE + 1)  # the first ones get no extra character
    start = number * size + F.greatest(F.lit(0), number - plain)
    size = size + (number >= plain).cast("int")

    index = (
        targets.where(F.length("v_given") >= shortest)
        .withColumn("v_length", F.length("v_given"))
        .withColumn("segment", F.explode(numbers))
        .withColumn("piece", F.substr("v_given", start + 1, size))
    )

    length = F.length("given")
    shift = length - v_length
    ahead = MAX_DISTANCE - number
    first = F.greatest(F.lit(0), start - number, start + shift - ahead)
    last = F.least(length - size, start + number, start + shift + ahead)
    lengths = F.sequence(F.greatest(F.lit(shortest), length - MAX_DISTANCE), length + MAX_DISTANCE)
    windows = (
        probes.where(length >= shortest)
        .withColumn("v_length", F.explode(lengths))
        .where(F.greatest(length, v_length) > pattern_length)
        .withColumn("segment", F.explode(numbers))
        .select("*", size.alias("size"), first.alias("first"), last.alias("last"))
        .where("first <= last")
    )
    pieces = F.transform(
        F.sequence("first", "last"), lambda at: F.substr(F.col("given"), at + 1, F.col("size"))
    )
    return _measured(
        windows.withColumn("piece", F.explode(F.array_distinct(pieces))).join(
            index.hint("merge"), ["last_name", "v_length", "segment", "piece"]
        )
    )
