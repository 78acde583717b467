"""Joining a lookup table, unique on its key, onto many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64_000_000
HOT_KEYS = 1_000


def attach(
    rows: DataFrame, table: DataFrame, key: str, frequency: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Left join ``table`` onto ``rows``; ``frequency`` is its column with the number of rows per key.

    A table of at most ``broadcast_rows`` rows and ``BROADCAST_BYTES`` bytes of keys is broadcast. Beyond that, keys
    with more than one row in ``HOT_KEYS`` are joined by broadcast, of which there are fewer than ``HOT_KEYS``, and
    only the rows of the other keys are shuffled. Both frames are read more than once, so pass work tables.
    """
    values = table.drop(frequency)
    size = F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0))
    count, size = table.agg(F.count("*"), size).first()
    if count <= broadcast_rows and size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(values), key, "left")
    total = table.agg(F.sum(frequency)).scalar()
    hot = table.filter(F.col(frequency) * HOT_KEYS > total).drop(frequency)
    hot_rows = rows.join(F.broadcast(hot), key)
    other_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(values.hint("merge"), key, "left")
    return hot_rows.unionByName(other_rows)
