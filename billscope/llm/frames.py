"""Helpers for the operators: chosen columns, Arrow batches and row order of a frame."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = 256


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """Two columns under fixed names, whatever else the frame holds; a null text is empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), *more)


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the frame doesn't hold."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def texts_of(column: pa.Array) -> Iterator[bytes | None]:
    """Texts as UTF-8, of which few are copied at a time."""
    for at in range(0, len(column), SLICE):
        yield from as_bytes(column.slice(at, SLICE))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows whose last column is a text, as UTF-8."""
    *others, text = batch.columns
    return zip(*(column.to_pylist() for column in others), texts_of(text), strict=True)
