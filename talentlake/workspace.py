"""Where jobs put intermediate tables that must outlive an executor."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
# With it, an execution's shuffle files go when it ends, not when the driver happens to collect them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting it is a folder of the warehouse, which all executors must reach too: on
    a cluster, a warehouse on the driver's disk is an error.
    """
    folder = spark.conf.get(SETTING, None)
    if not folder:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        one_machine = spark.sparkContext.master.split("[")[0] == "local"
        if not one_machine and (warehouse.startswith("file:") or "://" not in warehouse):
            raise ValueError(f"{SETTING} must name a folder that all executors share")
        folder = f"{warehouse}/_work"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/talentlake/{uuid.uuid4().hex}/{name}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind: the table stands for them."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as a parquet table and read it back: computed once, short lineage, and its
    shuffle files are deleted."""
    return stored_parts([df], name, **options)


def stored_parts(parts: Iterable[DataFrame], name: str, **options: str) -> DataFrame:
    """Like ``stored``, of the rows of all parts (one at least), each of which is made when the one
    before is written: the shuffle files of one part at a time lie on the disk."""
    path = None
    for part in parts:
        spark, schema = part.sparkSession, part.schema
        path = path or fresh_path(spark, name)
        with shuffles_dropped(spark):
            part.write.mode("append").options(**{"compression": "zstd"} | options).parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.stored_at = path
    return table


# Bytes of a table, as Spark's plan has it, that a pass over it should shuffle, and most passes.
BYTES_PER_PASS = 256 << 20
MOST_PASSES = 8


def passes_over(*tables: DataFrame) -> int:
    """How many passes the largest of them is worked on in: one if it is small or of unknown size."""
    sizes = [int(str(t._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for t in tables]
    known = [size for size in sizes if size < 1 << 60]
    return max(1, min(MOST_PASSES, -(-max(known, default=0) // BYTES_PER_PASS)))


def in_pass(table: DataFrame, number: int, passes: int, key: str) -> DataFrame:
    """The rows of one pass. Rows of one key are in the same pass, of whatever table."""
    return table if passes == 1 else table.where(F.pmod(F.xxhash64(key), F.lit(passes)) == number)


def discard(*tables: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more; other tables are left alone."""
    for table in tables:
        path = table.__dict__.get("stored_at")
        if path:
            folder = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
