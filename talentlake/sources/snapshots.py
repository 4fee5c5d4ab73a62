"""Day snapshots: one parquet dataset per zone, partitioned by a ``YYYYMMDD`` column.

Beside the days lies a ledger, a row per write: which day, how many rows. Readers of the dataset
do not see it, since its name begins with an underscore. It answers which day is the last one
with rows from a few small rows, where listing and opening the files of every day would not end
for a long history.

A day is rewritten beside the old one and swapped when all of it is written, so a job that dies
meanwhile leaves the old day as it was. The ledger is written last: a day counts once it is whole.
"""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = "event_date"
LEDGER = "_days"
LEDGER_SCHEMA = "day string, rows bigint, written timestamp"


def _swap_in(df: DataFrame, path: str, day: str, *observed: Column) -> dict:
    """Write ``df``'s days in place of the old ones; returns what was observed meanwhile.

    Spark stages the files and swaps a day's folder when the job commits. The rebalance hint
    gathers a day in few files, yet splits a day that is too large.
    """
    seen = Observation()
    (
        df.hint("rebalance", day)
        # Observed in the stage that writes, so that a stage run again is not counted twice.
        .observe(seen, *observed)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    return seen.get


def _record(spark: SparkSession, path: str, rows: dict[str, int]) -> None:
    now = datetime.datetime.now(datetime.timezone.utc)
    entries = [(day, n, now) for day, n in rows.items()]
    if entries:
        spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/{LEDGER}")


def write_snapshot(df: DataFrame, path: str, day: str = DAY) -> None:
    """Replace the days that ``df`` holds and leave all others alone."""
    spark = df.sparkSession
    days = _swap_in(df, path, day, F.collect_set(day).alias("days"))["days"]
    # Counted from the footers of the files just written.
    written = spark.read.schema(df.schema).parquet(path).where(F.col(day).isin(days)).groupBy(day).count()
    _record(spark, path, {r[0]: r[1] for r in written.collect()} if days else {})


def replace_day(df: DataFrame, path: str, value: str, day: str = DAY, **observed: Column) -> dict[str, int]:
    """Make ``df``'s rows of the day all that the day holds, even if there are none; returns
    ``rows``, how many there are, and what else is to be observed while they are written."""
    spark = df.sparkSession
    columns = [F.count("*").alias("rows"), *[column.alias(name) for name, column in observed.items()]]
    seen = _swap_in(df.where(F.col(day) == value), path, day, *columns)
    _record(spark, path, {value: seen["rows"]})
    if not seen["rows"]:  # nothing came to be swapped in
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{day}={value}")
        gone.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)
    return seen


def days_with_rows(spark: SparkSession, path: str, schema: T.StructType | str, day: str = DAY) -> DataFrame:
    """(day) of the days that hold rows, by the ledger; of a dataset that has none, by its files."""
    try:
        entries = spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/{LEDGER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_snapshots(spark, path, schema).select(F.col(day).alias("day")).distinct()
    return entries.groupBy("day").agg(F.max_by("rows", "written").alias("rows")).where("rows > 0").select("day")


def read_day(spark: SparkSession, path: str, schema: T.StructType | str, value: str, day: str = DAY) -> DataFrame:
    """One day, whose folder alone is listed and read."""
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{day}={value}")


def read_snapshots(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """All days. The declared schema keeps the day a string, where inference makes it int."""
    return spark.read.schema(schema).parquet(path)


def between(snapshots: DataFrame, first: str, last: str, day: str = DAY) -> DataFrame:
    """Days from ``first`` to ``last``; a partition filter, so other days are not read."""
    return snapshots.where(F.col(day).between(first, last))


def choose_days(asked: DataFrame, snapshots: DataFrame, day: str = DAY) -> DataFrame:
    """Add ``chosen_day`` to days ``as_of``: the day itself if present, else the last before.

    Answered once per distinct day asked, by a running maximum over the days of both sides (no
    more than the calendar has), and joined back on equality.
    """
    present = snapshots.select(F.col(day).alias("moment"), F.col(day).alias("present")).distinct()
    wanted = asked.select(F.col("as_of").alias("moment"), F.lit(None).cast("string").alias("present"))
    days = wanted.distinct().unionByName(present)
    upto = Window.orderBy("moment").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = (
        days.withColumn("chosen_day", F.max("present").over(upto))
        .groupBy(F.col("moment").alias("as_of"))
        .agg(F.max("chosen_day").alias("chosen_day"))
    )
    return asked.join(chosen, "as_of", "left")


def chosen_day(as_of: str, allow_later: bool = False) -> Column:
    """Aggregate over days (column ``day``): ``as_of`` itself if present, else the last before.

    ``allow_later`` falls back on the last one of all, even if it is later.
    """
    present = F.col("day")
    if allow_later:
        return F.coalesce(F.max(F.when(present == as_of, present)), F.max(present))
    return F.max(F.when(present <= as_of, present))


def read_as_of(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    as_of: str,
    day: str = DAY,
    allow_later: bool = False,
) -> DataFrame:
    """Rows of the snapshot of ``as_of`` if it has any, else of the last one before (or, with
    ``allow_later``, of the last one of all). Only the chosen day is listed and read."""
    days = days_with_rows(spark, path, schema, day)
    chosen = days.agg(chosen_day(as_of, allow_later)).first()[0]
    if chosen is None:
        return spark.createDataFrame([], schema)
    return read_day(spark, path, schema, chosen, day)
