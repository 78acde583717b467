"""Benchmark decontamination: find benchmark word windows inside documents, remove spans or documents.

Words are runs of letters and digits after A-Z became a-z. A benchmark item of ten words or more gives windows
of ten consecutive words; a shorter one is a single window of its own. The windows' hashes are broadcast, tasks
scan the documents' windows against them, and every hit is verified word by word.

A broadcast holds at most ``BLOCK_BYTES`` of benchmark text. A larger benchmark is split into blocks, the
documents are scanned once per block, and the hits of all blocks are joined.

Nulls: a null text has no words and is never contaminated; a benchmark row without words has no window. Windows
of an item with a null id mark words but are named by no id. Items that share an id count once. An empty
benchmark marks nothing; an empty table gives no rows. Repeated rows get the same answer each. Texts are scanned whole,
however long, one at a time. Other columns are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm.frames import as_bytes, free_name, texts_of
from billscope.operators.ordered import running_total
from billscope.work import materialise

WINDOW = 10
BLOCK_BYTES = 8_000_000
SEGMENT = 2_000  # words of a benchmark item in a row
BASE, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd multipliers of the rolling hash

RANGES = T.StructType([T.StructField(name, T.ArrayType(T.IntegerType())) for name in ("starts", "ends")])
HITS = T.StructType(
    [T.StructField("n_words", T.LongType()), *RANGES.fields, T.StructField("items", T.ArrayType(T.LongType()))]
)


def _word_table() -> bytes:
    """Each byte as words see it: A-Z small, digits, a-z and all bytes beyond ASCII as they are, else a space."""
    table = bytearray(b" " * 48 + bytes(range(48, 58)) + b" " * 39 + bytes(range(97, 123)) + b" " * 5)
    table += bytes(range(128, 256))
    table[65:91] = bytes(range(97, 123))
    return bytes(table)


TABLE = _word_table()
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Benchmark items as rows of bounded length that hold every window whole."""
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            words = words_of(text)
            for at in range(0, max(min(1, len(words)), len(words) - WINDOW + 1), SEGMENT):
                part = b" ".join(words[at : at + SEGMENT + WINDOW - 1]).decode()
                yield pa.RecordBatch.from_pydict({"item": pa.array([item], pa.int64()), "words": [part]})


def rolling(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of every window of ``length`` values, modulo 2^64."""
    count = len(values) - length + 1
    out = np.zeros(max(count, 0), np.uint64)
    for k in range(length if count > 0 else 0):
        out *= np.uint64(BASE)
        out += values[k : k + count]
    return out


class Index:
    """The distinct windows of a block of benchmark items, by hash."""

    def __init__(self, rows: list[tuple[int | None, str]]):
        split = [(item, words.encode().split()) for item, words in rows]
        vocabulary = sorted({word for _, words in split for word in words})
        self.vocabulary = {word: n for n, word in enumerate(vocabulary, 1)}
        self.values = (np.arange(len(vocabulary) + 1, dtype=np.uint64) + np.uint64(1)) * np.uint64(MIX)
        self.values ^= self.values >> np.uint64(29)
        self.values *= np.uint64(BASE)
        flat = [self.numbers(words) for _, words in split]
        self.flat = np.concatenate([*flat, np.empty(0, np.int64)])
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        at = 0
        for number, ((_, words), own) in enumerate(zip(split, flat, strict=True)):
            length = min(WINDOW, len(words))
            hashes = rolling(self.values[own], length)
            found.setdefault(length, []).append((hashes, np.arange(at, at + len(hashes)), np.full(len(hashes), number)))
            at += len(own)
        self.items = np.array([-1 if item is None else item for item, _ in rows], np.int64)
        self.named = np.array([item is not None for item, _ in rows], bool)
        self.by_length = {length: self._grouped(parts, length) for length, parts in found.items()}

    def _grouped(self, parts: list, length: int) -> tuple[np.ndarray, ...]:
        """Hash and place of each distinct window, and the rows it occurs in as slices of one array."""
        hashes, places, rows = (np.concatenate(column) for column in zip(*parts, strict=True))
        words = self.flat[places[:, None] + np.arange(length)]
        order = np.lexsort((*words.T, hashes))
        hashes, places, rows, words = hashes[order], places[order], rows[order], words[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (words[1:] != words[:-1]).any(1)
        first = np.flatnonzero(new)
        return hashes[first], places[first], np.append(first, len(hashes)), rows

    def numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(word, 0) for word in words], np.int64)

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merged word ranges that windows cover, and the ids of their items."""
        numbers = self.numbers(words)
        known = np.concatenate(([0], np.cumsum(numbers != 0)))
        cover, rows = np.zeros(len(words) + 1, np.int64), []
        for length, (hashes, places, slices, own_rows) in self.by_length.items():
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            if not len(starts):
                continue
            inside = numbers[starts[:, None] + np.arange(length)]
            seen = np.zeros(len(starts), np.uint64)
            for k in range(length):
                seen = seen * np.uint64(BASE) + self.values[inside[:, k]]
            low, high = np.searchsorted(hashes, seen), np.searchsorted(hashes, seen, "right")
            for step in range(int((high - low).max(initial=0))):  # more than one only where hashes collide
                at = np.flatnonzero(low + step < high)
                group = (low + step)[at]
                same = (self.flat[places[group][:, None] + np.arange(length)] == inside[at]).all(1)
                np.add.at(cover, starts[at[same]], 1)
                np.add.at(cover, starts[at[same]] + length, -1)
                rows += [own_rows[slices[g] : slices[g + 1]] for g in np.unique(group[same])]
        if not rows:
            return cover[:0], cover[:0], cover[:0]
        on = np.concatenate(([0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]))
        edges = np.flatnonzero(np.diff(on))
        rows = np.unique(np.concatenate(rows))
        return edges[::2], edges[1::2], np.unique(self.items[rows[self.named[rows]]])


_known: list = []


def _index(broadcast) -> Index:
    """The worker's index of a block; of the blocks before it keeps none."""
    if not _known or _known[0] is not broadcast:
        _known[:] = [broadcast, Index(broadcast.value)]
    return _known[1]


def _finder(broadcast):
    """Column function: the hits of one block of the benchmark in a text."""

    @F.arrow_udf(HITS)
    def find(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = _index(broadcast)
        for batch in texts:
            counts, starts, ends, items = [], [], [], []
            for text in texts_of(batch):
                words = words_of(text)
                found = index.hits(words)
                counts.append(len(words))
                for column, values in zip((starts, ends, items), found, strict=True):
                    column.append(values)
            columns = [pa.array(counts, pa.int64())]
            columns += [pa.array(c, pa.list_(pa.int32())) for c in (starts, ends)]
            columns.append(pa.array(items, pa.list_(pa.int64())))
            yield pa.StructArray.from_arrays(columns, names=HITS.names)

    return find.asNondeterministic()


@F.arrow_udf(RANGES)
def _merged(starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Ranges of several blocks as one list of ranges that don't touch."""
    out: tuple[list, list] = ([], [])
    for own in zip(starts.to_pylist(), ends.to_pylist(), strict=True):
        first, last = [], []
        for start, end in sorted(zip(*(values or () for values in own), strict=True)):
            if last and start <= last[-1]:
                last[-1] = max(last[-1], end)
            else:
                first.append(start)
                last.append(end)
        out[0].append(first)
        out[1].append(last)
    return pa.StructArray.from_arrays([pa.array(c, pa.list_(pa.int32())) for c in out], names=["starts", "ends"])


def with_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    into: str = "hits",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with a struct: words, ranges of hit words (end exclusive), ids of the items found.

    ``into`` gets underscores where the documents have such a column. The benchmark is taken in blocks of at most
    ``block_bytes`` and a segment.
    """
    spark, into = docs.sparkSession, free_name(docs, into)
    items = benchmark.select(F.col(f"`{item_col}`").cast("long"), F.col(f"`{item_text_col}`").cast("string"))
    segments = items.mapInArrow(_segments, "item long, words string").distinct()
    segments = materialise(segments.withColumn("size", F.octet_length("words") + 16), "benchmark")
    size = segments.agg(F.sum("size")).first()[0] or 0
    if size > block_bytes:
        order = [F.xxhash64("item", "words").asc(), F.asc("item"), F.asc("words")]
        segments = materialise(running_total(segments, order, F.col("size"), "up_to"), "benchmark-blocks")
        segments = segments.withColumn("block", F.floor((F.col("up_to") - F.col("size")) / block_bytes).cast("int"))
    else:
        segments = segments.withColumn("block", F.lit(0))
    blocks = math.ceil(size / block_bytes) or 1
    text = F.col(f"`{text_col}`").cast("string")

    def find(block: int) -> Column:
        rows = segments.where(F.col("block") == block).select("item", "words").collect()  # at most a block
        return _finder(spark.sparkContext.broadcast([tuple(row) for row in rows]))(text)

    if blocks == 1:
        return docs.withColumn(into, find(0))
    key = F.xxhash64(text, F.lit(1)).alias("key_a"), F.hash(text, F.length(text)).alias("key_b")
    found = None
    for block in range(blocks):
        part = docs.select(*key, find(block).alias("hits")).where(F.size("hits.starts") > 0)
        part = materialise(part.withColumn("block", F.lit(block)), "hits")
        found = part if found is None else found.unionByName(part)
    lists = F.collect_set(F.struct("block", "hits")).alias("own")
    found = found.groupBy("key_a", "key_b").agg(lists).select(
        "key_a",
        "key_b",
        _merged(F.expr("flatten(own.hits.starts)"), F.expr("flatten(own.hits.ends)")).alias("ranges"),
        F.expr("array_sort(array_distinct(flatten(own.hits.items)))").alias("items"),
    )
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *key, _count(text).alias("n_words"))
    empty = F.array().cast("array<int>")
    hits = F.struct(
        "n_words",
        F.coalesce("ranges.starts", empty).alias("starts"),
        F.coalesce("ranges.ends", empty).alias("ends"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"),
    )
    return kept.join(found, ["key_a", "key_b"], "left").select("row.*", hits.alias(into))


@F.arrow_udf(T.LongType())
def _count(texts: pa.Array) -> pa.Array:
    return pa.array([len(words_of(text)) for text in texts_of(texts)], pa.int64())


def n_hit(hits: str = "hits") -> Column:
    """Hit words of a struct of ``with_hits``."""
    return F.expr(f"aggregate(zip_with(`{hits}`.starts, `{hits}`.ends, (a, b) -> b - a), 0L, (n, w) -> n + w)")


@F.arrow_udf(T.StringType())
def _without(texts: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    """Texts without the given ranges of words; what stands between two words of a range goes with them."""
    out = []
    for text, first, last in zip(texts_of(texts), starts.to_pylist(), ends.to_pylist(), strict=True):
        if text and first:
            places = [(m.start(), m.end()) for m in WORD.finditer(text)]
            kept, at = [], 0
            for a, b in zip(first, last, strict=True):
                kept.append(text[at : places[a][0]])
                at = places[b - 1][1]
            text = b"".join([*kept, text[at:]])
        out.append(None if text is None else text.decode())
    return pa.array(out, pa.string())


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """The documents without contaminated ones (``documents``) or without the hit words (``spans``)."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    hits = free_name(docs, "hits")
    found = with_hits(docs, benchmark, text_col=text_col, into=hits, **options)
    if remove == "documents":
        return found.where(F.size(f"`{hits}`.starts") == 0).drop(hits)
    cut = _without(F.col(f"`{text_col}`"), F.col(f"`{hits}`.starts"), F.col(f"`{hits}`.ends"))
    return found.withColumn(text_col, cut).drop(hits)
