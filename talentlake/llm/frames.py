"""What the operators share: table access, row keys, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows, and bytes, of a batch that are turned into Python objects at once; a row that is larger
# goes alone.
SLICE_ROWS = 512
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_hash(text: str = "text") -> Column:
    """Second part of a row's key. A row is known by its id and this hash, so that rows
    without an id, and different rows with one id, stay apart; equal rows are treated alike."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    """Null-safe equality of columns of one name on both sides."""
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def _row_bytes(batch: pa.RecordBatch) -> np.ndarray:
    """Bytes of the texts of every row."""
    total = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            total += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return total


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS, size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Batches cut small, by rows and by bytes, so that Python objects of few texts exist at a time."""
    for batch in batches:
        ends = np.cumsum(_row_bytes(batch))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            fits = int(np.searchsorted(ends, before + size, side="right"))
            end = min(max(fits, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; a null text counts as an empty one."""
    return [text or "" for text in batch.column(name).to_pylist()]


def map_slices(
    df: DataFrame, function: Callable[[pa.RecordBatch], Any], schema: str
) -> DataFrame:
    """``mapInArrow`` of a function from a small batch to columns by name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            columns = function(batch)
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()],
                names=list(columns),
            )
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Hands the memory that this worker freed back to the system. Else it is kept for the worker's
    next task, and a stage stands beside what all stages before it once needed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


_remembered: dict[tuple, Any] = {}  # of this worker


def remembered(make: Callable[..., Any], *args: Any) -> Any:
    """``make(*args)``, made once in a worker and kept for the tasks that follow. Workers outlive
    a query, so only one such thing is kept: what another operator remembered goes."""
    key = (make, *args)
    if key not in _remembered:
        _remembered.clear()
        give_back()
        _remembered[key] = make(*args)
    return _remembered[key]


def typed(df: DataFrame, name: str) -> str:
    """A column's type as schema text, so that ids of any type pass through Arrow."""
    return df.schema[name].dataType.simpleString()


def first_of(names: Sequence[str], taken: Sequence[str]) -> dict[str, str]:
    """Names for working columns that clash with none of those taken (in any case)."""
    used = {name.lower() for name in taken}
    return {name: next(n for i in range(len(used) + 1) if (n := f"{name}{'_' * i}").lower() not in used) for name in names}
