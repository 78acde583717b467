"""Best-fit packing of token sequences by hierarchical residual packing.

Every task cuts its documents into pieces and packs them best fit, longest first. Bins that are nearly full
leave at once; underfull bins become the items of the next round, where fewer tasks, each fed by many of the
earlier ones, pack them again. Rounds end when one task held all that was left or a round joined next to
nothing. A task of a round is dealt about ``TASK_ITEMS`` pieces, or with ids ``TASK_ITEMS_WITH_IDS``, whatever their
lengths; pieces of one bin stay together.

Nulls: a null text is empty; a null id stays null. An empty document is one piece, its end id. Repeated rows
are packed as often as they occur. Pieces of equal length are packed in the order they come, equally full bins taken
last first. Very long texts are cut like others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm import tokens
from billscope.llm.frames import id_and_text, rows_of
from billscope.work import materialise

CAPACITY = 2048
END_ID = 0
TASK_ITEMS, TASK_ITEMS_WITH_IDS = 200_000, 4_000
#: A bin that lacks at most this share of the capacity leaves.
NEARLY_FULL = 1 / 128
#: A round has to lower the number of open bins by this share, or it was the last.
LEAST_GAIN = 0.01

COLUMNS = [
    ("doc_id", pa.int64()),
    ("piece", pa.int32()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("open", pa.bool_()),
]
SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, open boolean"


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item: longest first, each into the fullest bin that takes it.

    Bins are kept by their free space, and one integer has a bit for each free space that occurs.
    """
    bins, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces = made = 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            own = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            own, space, made = made, capacity, made + 1
        bins[item], offsets[item] = own, capacity - space
        left = space - size
        if left:
            by_space[left].append(own)
            spaces |= 1 << left
    return bins, offsets


def _first_id(level: int) -> int:
    """Numbers from here on are this task's own in this round."""
    return (level << 57) | (TaskContext.get().partitionId() << 35)


def _packed(own: dict[str, np.ndarray], capacity: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, offset and whether the sequence stays open, for pieces that lie in bins already or not."""
    bins, offsets = best_fit(own["size"], capacity)
    fill = np.bincount(bins, weights=own["size"]).astype(np.int64)
    is_open = fill < capacity - int(capacity * NEARLY_FULL)
    return first + bins, offsets, is_open[bins]


def _cut_and_pack(
    batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, end_id: int, with_ids: bool, escape: bool, items: int
) -> Iterator[pa.RecordBatch]:
    end, width = np.uint32(end_id).tobytes(), 4 * capacity
    first, rows = _first_id(0), []

    def packed(first: int) -> pa.RecordBatch:
        sizes = np.array([row[3] for row in rows], np.int64)
        sequences, offsets, is_open = _packed({"size": sizes}, capacity, first)
        columns = [*zip(*rows, strict=True)]
        arrays = [pa.array(values, kind) for values, (_, kind) in zip(columns[:5], COLUMNS, strict=False)]
        arrays += [pa.array(sequences), pa.array(offsets), pa.array(is_open)]
        names = [name for name, _ in COLUMNS]
        if with_ids:
            arrays, names = [*arrays, pa.array(columns[5], pa.binary())], [*names, "ids"]
        return pa.RecordBatch.from_arrays(arrays, names)

    for (doc_id, _), ids in tokens.encoded(chain.from_iterable(map(rows_of, batches)), tokenizer, 1, escape=escape):
        ids += end
        for piece, at in enumerate(range(0, len(ids), width)):
            own = ids[at : at + width]
            row = (doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own))
            rows.append((*row, own) if with_ids else row)
        if len(rows) >= items:
            yield packed(first)
            first, rows = first + len(rows), []
    if rows:
        yield packed(first)


def _pack_again(batches: Iterator[pa.RecordBatch], capacity: int, level: int) -> Iterator[pa.RecordBatch]:
    """One round over whole underfull bins: all pieces of a bin come to the same task and keep their order."""
    held = list(batches)
    if not sum(batch.num_rows for batch in held):
        return
    table = pa.Table.from_batches(held)
    bins, index = np.unique(table["sequence_id"].to_numpy(), return_inverse=True)
    fill = np.bincount(index, weights=table["length"].to_numpy()).astype(np.int64)
    sequences, offsets, is_open = _packed({"size": fill}, capacity, _first_id(level))
    changed = {
        "sequence_id": sequences[index],
        "offset": offsets[index] + table["offset"].to_numpy(),
        "open": is_open[index],
    }
    for name, values in changed.items():
        table = table.set_column(table.schema.get_field_index(name), name, pa.array(values))
    yield from table.to_batches(10_000)


def pack(
    docs: DataFrame,
    tokenizer: str = tokens.WORDS,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    escape: bool = False,
) -> DataFrame:
    """One row per piece of a document with its sequence and its place there.

    Documents of more than ``capacity`` ids are cut into pieces of that length, the last of them shorter.
    ``with_ids`` adds the ids of each piece as bytes, which ``sequences`` joins. With ``escape`` special-token strings
    inside texts are ordinary text.
    """
    schema, items = SCHEMA + (", ids binary" if with_ids else ""), TASK_ITEMS_WITH_IDS if with_ids else TASK_ITEMS
    cut = partial(
        _cut_and_pack, tokenizer=tokenizer, capacity=capacity, end_id=end_id, with_ids=with_ids, escape=escape, items=items
    )
    packed = materialise(id_and_text(docs, id_col, text_col).mapInArrow(cut, schema), "pieces")
    done, level = packed.where(~F.col("open")), 0
    waiting = packed.where("open")
    bins = waiting.where(F.col("offset") == 0).count()
    while bins:
        level += 1
        tasks = math.ceil(waiting.count() / items)
        again = partial(_pack_again, capacity=capacity, level=level)
        dealt = waiting.repartition(tasks, F.xxhash64("sequence_id", F.lit(level)))
        packed = materialise(dealt.mapInArrow(again, schema), "repacked")
        left = packed.where((F.col("offset") == 0) & F.col("open")).count()
        if tasks == 1 or left > bins * (1 - LEAST_GAIN) or level == 63:
            return done.unionByName(packed).drop("open")
        done = done.unionByName(packed.where(~F.col("open")))
        waiting, bins = packed.where("open"), left
    return done.drop("open")


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from ``pack(..., with_ids=True)``: ids as little-endian unsigned 32-bit bytes."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    grouped = packed.groupBy("sequence_id").agg(pieces.alias("pieces"), F.sum("length").alias("length"))
    return grouped.select(
        "sequence_id",
        "length",
        F.expr("aggregate(pieces, X'', (ids, p) -> concat(ids, p.ids))").alias("ids"),
        F.expr("transform(pieces, p -> struct(p.offset, p.doc_id, p.piece))").alias("pieces"),
    )
