"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark.

Tasks hash every window of ``WINDOW`` consecutive words by a rolling polynomial modulo 2^64. A window that also
occurs earlier within the same chunk of documents is a repeat already and goes straight to its document; every other
one goes, by its hash, to a bucket, where equal hashes of all chunks meet and all but the first are repeats. So a
bucket sees a window at most once a chunk, however many documents hold it. Windows travel as sorted, compressed
arrays, a few bytes each. The repeats of a document come back to it by side files and merge into maximal intervals, which
are removed; texts are read, never shuffled.

The order of documents is by id, null first, and within rows of one id by two 64-bit hashes of the text, which
travel only where several texts share an id; rows with the same id and text are one document, and each gets its answer. Null and empty texts have no words; shorter texts than
a window have no repeats. An empty table gives no rows. Other columns are ignored, or kept by ``clean``. Windows
are equal if their 64-bit hash and a check of 32 bits from other hashes of their words are: at 5e9 windows one false
match in several billion such jobs is to be expected.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm.frames import SLICE, free_name, rows_of, texts_of
from billscope.llm.shared import SideFiles, located
from billscope.work import materialise

WINDOW = 20
BASE, CHECK_BASE, CHECK_SEED = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 1
CHUNK_WINDOWS = 1_500_000
#: Bytes of text whose windows share a bucket; a task holds one bucket.
BUCKET_BYTES = 16_000_000
#: Bytes of text whose repeats are gathered together.
TARGET_BYTES = 64_000_000
MOST_WORDS = 250_000  # distinct words a worker remembers
NO_ID = -(1 << 63)
KEYS = ("own_id", "text_key", "more_key")

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
)


class _Words(dict):
    """Numbers of words, remembered, and two 64-bit hashes of each."""

    def __init__(self):
        self.hashes, self.checks = array("Q"), array("Q")

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        self.hashes.append(xxh64_intdigest(word))
        self.checks.append(xxh64_intdigest(word, CHECK_SEED))
        number = self[word] = len(self)
        return number

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) >= MOST_WORDS:
            self.clear()
            self.hashes, self.checks = array("Q"), array("Q")
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.frombuffer(self.hashes, np.uint64)[numbers], np.frombuffer(self.checks, np.uint64)[numbers]


def window_hashes(words: np.ndarray, window: int, base: int = BASE) -> np.ndarray:
    """Hash of each window: its words' hashes as a polynomial, modulo 2^64, mixed so that all bits count."""
    count = len(words) - window + 1
    out = np.zeros(max(count, 0), np.uint64)
    for k in range(window if count > 0 else 0):
        out *= np.uint64(base)
        out += words[k : k + count]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def _planes(values: np.ndarray, kind: str) -> bytes:
    """Numbers with their bytes transposed, so that equal high bytes stand together, and compressed."""
    size = np.dtype(kind).itemsize
    planes = np.ascontiguousarray(values.astype(kind).view(np.uint8).reshape(len(values), size).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _numbers(data: pa.Buffer, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, len(planes) // size).T).view(kind).ravel()


DOC, DOC_KINDS = ("ids", "keys", "more_keys"), ("<i8", "<i8", "<i8")
FOUND, FOUND_KINDS = (*DOC, "counts", "starts"), (*DOC_KINDS, "<u4", "<u4")
FOUND_SCHEMA = pa.schema([("target", pa.int32()), *((name, pa.binary()) for name in FOUND)])
PARTS = ("hashes", "checks", "owners", "starts", "repeat_owners", "repeat_starts", *DOC)
KINDS = ("<u8", "<u4", "<u4", "<u4", "<u4", "<u4", *DOC_KINDS)


def _first_of(hashes: np.ndarray, checks: np.ndarray, owners: np.ndarray, starts: np.ndarray, docs: list[np.ndarray]):
    """Order by hash, check and place, whether each is its window's first, and whether it is the same place as that."""
    own = [part[owners] for part in docs]
    order = np.lexsort((starts, *own[::-1], checks, hashes))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (checks[order][1:] != checks[order][:-1])
    leader = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    same = starts[order] == starts[leader]
    for part in own:
        same &= part[order] == part[leader]
    return order, new, same


def _target_of(docs: list[np.ndarray], targets: int) -> np.ndarray:
    """The target that gathers a document's repeats, by a hash of its key."""
    mixed = (docs[0].view(np.uint64) ^ docs[1].view(np.uint64)) * np.uint64(BASE)
    return ((mixed >> np.uint64(32)) * np.uint64(targets) >> np.uint64(32)).astype(np.int64)


def _hash(batches: Iterator[pa.RecordBatch], window: int, buckets: int, targets: int) -> Iterator[pa.RecordBatch]:
    """Windows by bucket; the chunk's own repeats by their documents' targets, numbered after the buckets."""
    known = _Words()
    docs, parts, lengths, held = [], [], [], 0

    def chunk() -> Iterator[pa.RecordBatch]:
        count = np.array(lengths)
        hashes, checks = (np.concatenate(p) for p in zip(*parts, strict=True))
        hashes, checks = window_hashes(hashes, window), window_hashes(checks, window, CHECK_BASE)
        checks = (checks >> np.uint64(32)).astype(np.uint32)
        ends = np.cumsum(count)
        owners = np.repeat(np.arange(len(count), dtype=np.uint32), count)[: len(hashes)]
        starts = (np.arange(len(hashes)) - (ends - count)[owners]).astype(np.uint32)
        whole = starts + window <= count[owners]
        hashes, checks, owners, starts = hashes[whole], checks[whole], owners[whole], starts[whole]
        own_docs = [np.array(part, np.int64) for part in zip(*docs, strict=True)]
        # Only windows that share a hash need to be put in order of place.
        by_hash = np.argsort(hashes)
        equal = hashes[by_hash][1:] == hashes[by_hash][:-1]
        shared = np.zeros(len(hashes), bool)
        shared[1:] |= equal
        shared[:-1] |= equal
        several = by_hash[shared]
        order, new, same = _first_of(hashes[several], checks[several], owners[several], starts[several], own_docs)
        repeat = np.zeros(len(hashes), bool)
        repeat[several[order[~same]]] = True
        dropped = np.zeros(len(hashes), bool)
        dropped[several[order[~new]]] = True
        kind = np.min_scalar_type(buckets + targets)
        bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(kind)
        bucket[repeat] = (buckets + _target_of(own_docs, targets))[owners[repeat]].astype(kind)
        # In order of place within a bucket, owners and starts take the least room.
        sent, repeats = (some[np.argsort(bucket[some], kind="stable")] for some in map(np.flatnonzero, (~dropped, repeat)))
        cuts = np.searchsorted(bucket[sent], np.arange(buckets + targets + 1))
        repeat_cuts = np.searchsorted(bucket[repeats], np.arange(buckets + targets + 1))
        place = np.zeros(len(count), np.uint32)
        rows = []
        for number in np.flatnonzero((np.diff(cuts) > 0) | (np.diff(repeat_cuts) > 0)).tolist():
            own = sent[cuts[number] : cuts[number + 1]]
            again = repeats[repeat_cuts[number] : repeat_cuts[number + 1]]
            here = np.zeros(len(count), bool)
            here[owners[own]] = here[owners[again]] = True
            some = np.flatnonzero(here)
            place[some] = np.arange(len(some))
            columns = (hashes[own], checks[own], place[owners[own]], starts[own], place[owners[again]], starts[again])
            columns += tuple(part[some] for part in own_docs)
            rows.append((number, *(_planes(c, k) for c, k in zip(columns, KINDS, strict=True))))
            if len(rows) == 16:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    for batch in batches:
        for *doc, text in rows_of(batch):
            words = (text or b"").split()
            if len(words) < window:
                continue
            docs.append(doc)
            lengths.append(len(words))
            parts.append(known.of(words))
            held += len(words)
            if held >= CHUNK_WINDOWS:
                yield from chunk()
                docs, parts, lengths, held = [], [], [], 0
    if parts:
        yield from chunk()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    numbers, *columns = zip(*rows, strict=True)
    arrays = [pa.array(numbers, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", *PARTS])


def _repeats(batches: Iterator[pa.RecordBatch], targets: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of a bucket, or those that chunks found by themselves.

    A task holds one bucket. Documents are dealt to ``targets`` by a hash, and a row holds the windows of all documents
    of a target.
    """
    held = list(batches)
    if not sum(batch.num_rows for batch in held):
        return
    table = pa.Table.from_batches(held)
    columns: list[list[np.ndarray]] = [[] for _ in PARTS]
    docs = 0
    for row in range(table.num_rows):
        own = [_numbers(table[name][row].as_buffer(), kind) for name, kind in zip(PARTS, KINDS, strict=True)]
        own[2], own[4] = own[2] + np.uint32(docs), own[4] + np.uint32(docs)
        docs += len(own[6])
        for column, values in zip(columns, own, strict=True):
            column.append(values)
    hashes, checks, owners, starts, again_owners, again_starts, *doc = map(np.concatenate, columns)
    del columns, own
    by_hash = np.argsort(hashes)
    equal = hashes[by_hash][1:] == hashes[by_hash][:-1]
    shared = np.zeros(len(hashes), bool)
    shared[1:] |= equal
    shared[:-1] |= equal
    several = by_hash[shared]
    del by_hash, equal, shared
    order, _, same = _first_of(hashes[several], checks[several], owners[several], starts[several], doc)
    found = several[order[~same]]
    owners = np.concatenate([owners[found], again_owners])
    starts = np.concatenate([starts[found], again_starts])
    doc, counts, starts = _by_document([part[owners] for part in doc], starts)
    target = _target_of(doc, targets)
    window_target = np.repeat(target, counts)
    docs, own = np.argsort(target, kind="stable"), np.argsort(window_target, kind="stable")
    doc_cuts, cuts = (np.searchsorted(np.sort(t), np.arange(targets + 1)) for t in (target, window_target))
    rows = []
    for number in np.unique(target).tolist():
        some = docs[doc_cuts[number] : doc_cuts[number + 1]]
        columns = *(part[some] for part in doc), counts[some], starts[own[cuts[number] : cuts[number + 1]]]
        rows.append((number, *(_planes(c, k) for c, k in zip(columns, FOUND_KINDS, strict=True))))
    found = pa.Table.from_pylist([dict(zip(("target", *FOUND), row, strict=True)) for row in rows], FOUND_SCHEMA)
    yield from found.to_batches()


def _by_document(docs: list[np.ndarray], starts: np.ndarray):
    """Distinct starts in order of place: the documents, starts in each, the starts."""
    order = np.lexsort((starts, *docs[::-1]))
    docs, starts = [part[order] for part in docs], starts[order]
    new_doc = np.zeros(len(starts), bool)
    new_doc[:1] = True
    for part in docs:
        new_doc[1:] |= part[1:] != part[:-1]
    new = new_doc.copy()
    new[1:] |= starts[1:] != starts[:-1]
    first = np.flatnonzero(new_doc[new])
    counts = np.diff(np.append(first, new.sum()))
    return [part[new_doc] for part in docs], counts, starts[new]


def _gather(table: pa.Table) -> pa.Table:
    """Repeated windows of some documents, from all buckets."""
    columns: list[list[np.ndarray]] = [[] for _ in FOUND]
    for row in range(table.num_rows):
        for column, name, kind in zip(columns, FOUND, FOUND_KINDS, strict=True):
            column.append(_numbers(table[name][row].as_buffer(), kind))
    *docs, counts, starts = map(np.concatenate, columns)
    docs, counts, starts = _by_document([np.repeat(part, counts) for part in docs], starts)
    bounds = np.append(0, np.cumsum(counts)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(starts.astype(np.int32)))
    return pa.table([*map(pa.array, docs), lists], [*KEYS, "starts"])


def _starts_of(sides: SideFiles, file: int, places: np.ndarray) -> dict[int, np.ndarray]:
    """First words of the repeated windows of some of a file's documents, by their places."""
    table = sides.of(file, places, "place", "starts")
    if table is None or not table.num_rows:
        return {}
    lists = table["starts"].combine_chunks()
    starts, bounds = lists.values.to_numpy(), lists.offsets.to_numpy()
    return {place: starts[bounds[n] : bounds[n + 1]] for n, place in enumerate(table["place"].to_pylist())}


def _cut(window: int, sides: SideFiles):
    @F.arrow_udf(RESULT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        """Words and removed words, and what is left, joined by one space; some rows of a batch at a time."""
        for column, files, places in batches:
            files, places = files.to_numpy(), places.to_numpy()
            known = {file: _starts_of(sides, file, places[files == file]) for file in np.unique(files).tolist()}
            for at in range(0, len(column), SLICE):
                some = slice(at, at + SLICE)
                rows = zip(texts_of(column[some]), files[some].tolist(), places[some].tolist(), strict=True)
                counts, removed, left, digests = [], [], [], []
                for text, file, place in rows:
                    words, own = (text or b"").split(), known[file].get(place)
                    counts.append(len(words))
                    if own is not None:
                        edges = np.zeros(len(words) + 1, np.int64)
                        own = np.unique(own)
                        np.add.at(edges, own, 1)
                        np.add.at(edges, own + window, -1)
                        kept = np.cumsum(edges[:-1]) == 0
                        words = [words[k] for k in np.flatnonzero(kept).tolist()]
                    removed.append(counts[-1] - len(words))
                    rest = b" ".join(words)
                    left.append(None if text is None else rest.decode())
                    digests.append(hashlib.sha256(rest).hexdigest())
                arrays = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.string())]
                yield pa.StructArray.from_arrays([*arrays, pa.array(digests, pa.string())], names=RESULT.names)

    return cut.asNondeterministic()


def _own_id(id_col: str) -> Column:
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("own_id")


def _text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit("more"), text)


def _shared_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids of rows with different texts."""
    keys = F.struct(*_text_keys(F.col(f"`{text_col}`").cast("string"))).alias("keys")
    by_id = docs.select(_own_id(id_col), keys).groupBy("own_id").agg(F.min("keys").alias("a"), F.max("keys").alias("b"))
    return materialise(by_id.where("a <> b").select("own_id", F.lit(True).alias("shared")), "shared-ids")


def _keyed(docs: DataFrame, shared: DataFrame, id_col: str, text_col: str, *columns: Column) -> DataFrame:
    """The columns by the key of their document: its id, and hashes of its text where others share the id."""
    text = F.col(f"`{text_col}`").cast("string")
    own = docs.select(_own_id(id_col), *(k.alias(f"key{n}") for n, k in enumerate(_text_keys(text))), *columns)
    keys = (F.when(F.col("shared"), F.col(f"key{n}")).otherwise(F.lit(0)).alias(KEYS[1 + n]) for n in (0, 1))
    return own.join(shared, "own_id", "left").select("own_id", *keys, *own.columns[3:])


def repeated(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    shared: DataFrame | None = None,
) -> DataFrame:
    """(own_id, text_key, more_key, starts): the first words of each document's windows that occur earlier too."""
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    shared = _shared_ids(docs, id_col, text_col) if shared is None else shared
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    schema = "bucket int, " + ", ".join(f"{name} binary" for name in PARTS)
    keyed = _keyed(docs, shared, id_col, text_col, text)
    targets = max(1, math.ceil(size / TARGET_BYTES))
    hashed = keyed.mapInArrow(partial(_hash, window=window, buckets=buckets, targets=targets), schema)
    dealt = hashed.repartitionById(buckets + targets, "bucket")
    schema = "target int, " + ", ".join(f"{name} binary" for name in FOUND)
    found = dealt.mapInArrow(partial(_repeats, targets=targets), schema)
    keys = ", ".join(f"{name} long" for name in KEYS)
    return found.groupBy("target").applyInArrow(_gather, f"{keys}, starts array<int>")


def with_cut(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", into: str = "cut"
) -> DataFrame:
    """The documents with a struct: words, removed words, the text that is left and its sha256.

    ``into`` gets underscores where there is such a column.
    """
    into = free_name(docs, into)
    docs, file, place = located(docs)
    shared = _shared_ids(docs, id_col, text_col)
    found = materialise(repeated(docs, window, id_col, text_col, shared), "repeats")
    rows = _keyed(docs, shared, id_col, text_col, file, place).join(found, [*KEYS]).select("file", "place", "starts")
    sides = SideFiles(rows, docs.count(), "repeated-windows")
    return docs.withColumn(into, _cut(window, sides)(F.col(f"`{text_col}`").cast("string"), file, place))


def clean(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents with repeated windows removed; words of changed texts are joined by one space."""
    into = free_name(docs, "cut")
    found = with_cut(docs, text_col=text_col, into=into, **options)
    own = F.when(F.col(f"{into}.n_removed") > 0, F.col(f"{into}.text")).otherwise(F.col(f"`{text_col}`"))
    return found.withColumn(text_col, own).drop(into)
