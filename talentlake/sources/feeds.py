"""JSON feeds: one multi-line document per file, an envelope object or an array of rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class MissingResponseError(ValueError):
    """No envelope of a feed has a ``response``."""


def read_feed(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Files at ``path`` (a glob, usually a day's folder), by a declared schema.

    An envelope file gives one row, an array file one row per element. Fields that a
    document lacks are NULL. A multi-line file is read by one task, so a large feed should
    land in many files, or as one document per line (``multi_line=False``), which splits.
    """
    return spark.read.schema(schema).json(path, multiLine=multi_line)


def require_response(envelopes: DataFrame) -> DataFrame:
    """The envelopes as they are, if any has a ``response``; reads until the first has."""
    if envelopes.where("response is not null").isEmpty():
        raise MissingResponseError("no envelope has a 'response' field")
    return envelopes


def feed_or_none(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame | None:
    """``read_feed``, or None when nothing landed at ``path``."""
    try:
        return read_feed(spark, path, schema, multi_line)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def feed_or_empty(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """``read_feed``, or an empty frame of that schema when nothing landed at ``path``."""
    feed = feed_or_none(spark, path, schema, multi_line)
    return spark.createDataFrame([], schema) if feed is None else feed
