"""Token ids in files: fixed-width bit packing with block offsets.

A file holds ids in blocks of ``BLOCK`` ids, each id in the fewest bits that the vocabulary needs, then an index
(document ids, their lengths, the offset of each block) and a trailer of fixed size. Any range of ids is read by
seeking to its blocks, and a block is unpacked by numpy at once. Files are written by the tasks themselves
through ``pyarrow.fs`` (local and shared folders, S3, GCS; HDFS where libhdfs is installed), under a name of the
attempt first and then renamed, so a task that is repeated replaces its own file.

Nulls: a null text is empty; a null id comes first. Rows that share an id follow in the order of the input. An
empty document has its end id alone. An empty table gives no documents. Other columns are ignored.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billscope.llm import tokens
from billscope.llm.frames import id_and_text, rows_of
from billscope.llm.shared import place, qualified

BLOCK = 16_384
MAGIC = b"IDBLOCK1"
TRAILER = struct.Struct("<IIQQQ8s")  # bits, ids a block, ids, documents, place of the index, magic
END_ID = 2
#: Ids that a task reads back at least, where all cores have work, and written files whose rows share a file of the list.
TASK_IDS, LISTED = 32_000_000, 100_000


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after the other, lowest bit first, filled up to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, count: int, bits: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    weights = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return (planes.reshape(count, bits) * weights).sum(1, dtype=np.uint32)


class Writer:
    """Writes one file; documents come whole, ids leave in blocks."""

    def __init__(self, path: str, bits: int):
        self.store, self.path = place(path)
        self.draft = f"{self.path}.{uuid.uuid4().hex}"
        self.out, self.bits = self.store.open_output_stream(self.draft), bits
        self.out.write(MAGIC)
        self.at, self.offsets, self.waiting, self.size = len(MAGIC), [], [], 0
        self.doc_ids, self.missing, self.lengths = [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if len(ids) and int(ids.max()) >> self.bits:
            raise ValueError(f"an id does not fit into {self.bits} bits")
        self.doc_ids.append(doc_id or 0)
        self.missing.append(doc_id is None)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.size += len(ids)
        if self.size >= 16 * BLOCK:
            self._flush(self.size // BLOCK * BLOCK)

    def _flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for at in range(0, count, BLOCK):
            packed = pack_bits(ids[at : min(at + BLOCK, count)], self.bits)
            self.offsets.append(self.at)
            self.out.write(packed)
            self.at += len(packed)
        self.waiting, self.size = [ids[count:]], len(ids) - count

    def close(self) -> tuple[int, int]:
        """Documents and ids of the finished file."""
        self._flush(self.size)
        count = sum(self.lengths)
        for values, kind in ((self.doc_ids, "<i8"), (self.missing, "u1"), (self.lengths, "<i8"), (self.offsets, "<u8")):
            self.out.write(np.array(values, kind).tobytes())
        self.out.write(TRAILER.pack(self.bits, BLOCK, count, len(self.lengths), self.at, MAGIC))
        self.out.close()
        self.store.move(self.draft, self.path)
        return len(self.lengths), count


class Reader:
    """One file: its documents, and any range of its ids."""

    def __init__(self, path: str):
        store, own = place(path)
        self.file = store.open_input_file(own)
        end = self.file.size() - TRAILER.size
        self.bits, self.block, self.count, documents, index, magic = TRAILER.unpack(self._read(end, TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        data = self._read(index, end - index)
        self.doc_ids = np.frombuffer(data, "<i8", documents)
        self.missing = np.frombuffer(data, "u1", documents, 8 * documents).astype(bool)
        self.lengths = np.frombuffer(data, "<i8", documents, 9 * documents)
        self.offsets = np.frombuffer(data, "<u8", offset=17 * documents)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        held = min((last + 1) * self.block, self.count) - first * self.block
        at = int(self.offsets[first])
        whole = unpack_bits(self._read(at, (held * self.bits + 7) // 8), held, self.bits)
        return whole[start - first * self.block : stop - first * self.block]

    def document(self, number: int) -> np.ndarray:
        start = int(self.starts[number])
        return self.ids(start, start + int(self.lengths[number]))

    def documents(self, at_once: int = 64 * BLOCK) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document id, first id's place in the file and ids, reading many documents at a time."""
        number = 0
        while number < len(self.lengths):
            start = int(self.starts[number])
            last = max(number + 1, int(np.searchsorted(self.starts, start + at_once)))
            ids = self.ids(start, int(self.starts[last - 1] + self.lengths[last - 1]))
            for n in range(number, last):
                own = int(self.starts[n]) - start
                doc_id = None if self.missing[n] else int(self.doc_ids[n])
                yield doc_id, int(self.starts[n]), ids[own : own + int(self.lengths[n])]
            number = last


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int, bits: int, escape: bool):
    shard = TaskContext.get().partitionId()
    path, writer = f"{folder}/part-{shard:06d}.ids", None
    end = np.uint32(end_id).tobytes()
    rows = chain.from_iterable(map(rows_of, batches))
    for (doc_id, _), ids in tokens.encoded(rows, tokenizer, 1, remember=True, escape=escape):
        writer = writer or Writer(path, bits)
        writer.add(doc_id, np.frombuffer(ids + end, "<u4"))
    if writer:
        documents, count = writer.close()
        row = {"shard": [shard], "path": [path], "documents": [documents], "ids": [count]}
        yield pa.RecordBatch.from_pydict(row, pa.schema(zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))))


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str = tokens.SPACED,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    escape: bool = False,
) -> DataFrame:
    """Write the ids of all documents to files in ``folder``, in ascending id order over all files.

    Returns one row a file (shard, path, documents, ids), which is stored beside the files: apart from the tasks that
    encode, and in few files, as Spark may start processes for each. With ``escape`` special-token strings inside texts
    are ordinary text.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)
    store, own = place(folder)
    store.create_dir(f"{own}/data")
    bits = bits_for(max(tokens.encoder(tokenizer).tokenizer.get_vocab_size(), end_id + 1))
    dealt = id_and_text(docs, id_col, text_col, F.monotonically_increasing_id().alias("row"))
    dealt = dealt.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")
    job = partial(_write, folder=f"{folder}/data", tokenizer=tokenizer, end_id=end_id, bits=bits, escape=escape)
    files = dealt.mapInArrow(job, "shard int, path string, documents long, ids long")
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files.repartition(math.ceil(most / LISTED)).write.parquet(f"{folder}/files")
    return listing(spark, folder)


def listing(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/files")


def _read_back(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    kinds = [pa.int64()] * 4 + [pa.binary()] * with_ids
    for batch in batches:
        for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows, held = [], 0
            for doc_id, start, ids in Reader(path).documents():
                data = ids.tobytes()
                rows.append((doc_id, before + start, len(ids), zlib.crc32(data), *[data] * with_ids))
                held += len(data) if with_ids else 64
                if held >= 16_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document, from the files: where its ids start among all, how many they are, their crc32.

    A task reads file after file, some blocks at a time: as many tasks as cores, or one for each ``TASK_IDS``.
    """
    files = listing(spark, folder)
    count, ids = files.agg(F.count("*"), F.coalesce(F.sum("ids"), F.lit(0))).first()
    tasks = min(count, max(spark.sparkContext.defaultParallelism, math.ceil(ids / TASK_IDS)))
    # One row a file: the running total is over files, never over documents.
    before = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")
    placed = files.select("path", before.alias("before"))
    dealt = placed.repartition(max(1, tasks))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return dealt.mapInArrow(partial(_read_back, with_ids=with_ids), schema)
