"""Compare a Spark query with its SQL twin: columns, row count and values, in any row order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple((type(row[i]).__name__, _plain(row[i])) for i in order) for row in rows)


def difference(spark_frame, connection, sql: str) -> str | None:
    """None if equal, else what differs first."""
    result = connection.execute(sql)
    sql_columns = [column[0] for column in result.description]
    if sorted(spark_frame.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_columns)}"
    ours = _bag((tuple(row) for row in spark_frame.collect()), spark_frame.columns)
    theirs = _bag(result.fetchall(), sql_columns)
    if ours.total() != theirs.total():
        return f"{ours.total()} rows != {theirs.total()}"
    extra = ours - theirs
    if extra:
        return f"{extra.total()} rows differ, first {min(extra, key=str)} vs {min(theirs - ours, key=str)}"
    return None
