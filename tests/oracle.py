"""Compare a registered query with its SQL on DuckDB, value by value."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# DuckDB's names of the Spark types that results use.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(df, con, sql) -> str:
    """Empty when both sides have the same columns, types of value and rows."""
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    other = {c: (t, types[c]) for c, t in df.dtypes if TYPES[t] != types[c]}
    if other:
        return f"types {other}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if actual == expected:
        return "" if expected else "no rows"
    extra, missing = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows != {sum(expected.values())}; "
        f"extra {list(extra.items())[:3]}, missing {list(missing.items())[:3]}"
    )
