"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint has a bit set where more than half of its shingles' XXH64 hashes have it. Equal
fingerprints are one node. Two fingerprints that differ in at most ``RADIUS`` bits agree in all but ``RADIUS``
of ``BLOCKS`` bit blocks, so nodes meet under every choice of blocks that may agree. Where they meet, their
fingerprints are stored as vertical bit planes, one word holding the same bit of 64 of them; the distances of
many pairs are added up together by carry-save counters, and a block ends early when all its pairs are beyond
the radius. A meeting place of more than ``TILE`` nodes is cut into tiles that are compared pair by pair in
tasks of their own. Tasks return spanning links only, and links are joined to components in Spark.

Nulls: a null text has no words. Texts without words have fingerprint zero and link like any other. Rows with a
null id get the component of their fingerprint, or null where no row of it has an id. Repeated rows are copies
of each other, and rows that share an id only are not. An empty table gives no rows. Other columns are ignored, or kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm.components import components
from billscope.llm.frames import texts_of
from billscope.llm.groups import roots, runs
from billscope.llm.shared import SideFiles, located
from billscope.work import in_few_files, materialise

SHINGLE, RADIUS, SEED = 3, 2, 42
BLOCKS = 5
TILE = 2048
SMALL = 32  # groups up to this size are compared many at a time
CHUNK = 500_000  # shingles whose bits are counted at once

BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingles(words: list[bytes], size: int) -> Iterable[bytes]:
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    return map(b" ".join, zip(*(words[k:] for k in range(size)), strict=False))


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """64 bits, unsigned; zero for a text without words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return 0
    count = max(1, len(words) - size + 1)
    hashes = np.fromiter(map(xxh64_intdigest, shingles(words, size), repeat(SEED)), np.uint64, count)
    seen = np.zeros(8 * 256, np.int64)
    places = 256 * np.arange(8)
    for at in range(0, count, CHUNK):
        own = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        seen += np.bincount((own + places).ravel(), minlength=8 * 256)
    set_in = seen.reshape(8, 256) @ BITS
    return int.from_bytes(np.packbits(2 * set_in > count, bitorder="little").tobytes(), "little")


def fingerprint_of(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf(T.LongType())
    def own(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t, size) for t in texts_of(texts)], np.uint64).view(np.int64))

    return own(text)


def meeting_keys(radius: int) -> list[Column]:
    """One number for each choice of blocks that may agree; the choice's number is in the top bits."""
    bounds = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - radius)):
        key, width = F.lit(number).cast("long"), 0
        for block in chosen:
            low, size = bounds[block], bounds[block + 1] - bounds[block]
            bits = F.shiftrightunsigned("fp", low).bitwiseAND((1 << size) - 1)
            key, width = F.shiftleft(key, size).bitwiseOR(bits), width + size
        if width + len(keys).bit_length() > 62:
            raise ValueError("the radius is too small for numbers of 64 bits")
        keys.append(key)
    return keys


def planes(prints: np.ndarray) -> np.ndarray:
    """Fingerprints as 64 rows of words: row k holds bit k of all of them."""
    padded = np.zeros(-(-len(prints) // 64) * 64, np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view("<u8").astype(np.uint64)


def within(differences: Iterator[np.ndarray], radius: int) -> np.ndarray:
    """Which lanes have at most ``radius`` bits set over all difference planes.

    A lane's counter has ``radius.bit_length()`` bits, kept in as many words, and starts so that the count after
    the radius carries out of it. All lanes beyond the radius: the rest of the planes is not looked at.
    """
    size, counters, beyond = radius.bit_length(), [], None
    start = (1 << size) - 1 - radius
    for number, carry in enumerate(differences):
        if beyond is None:
            beyond = np.zeros_like(carry)
            counters = [np.full_like(carry, ONES if start >> bit & 1 else 0) for bit in range(size)]
        for bit in range(size):
            counters[bit], carry = counters[bit] ^ carry, counters[bit] & carry
        beyond |= carry
        if number % 8 == 7 and (beyond == ONES).all():
            break
    return ~beyond


def lanes(words: np.ndarray) -> np.ndarray:
    """Words of 64 lanes as booleans, along the last axis."""
    whole = np.ascontiguousarray(words).astype("<u8").view(np.uint8)
    return np.unpackbits(whole, axis=-1, bitorder="little").astype(bool)


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """For pairs of fingerprints, lane by lane: whether they are within the radius."""
    return lanes(within(iter(planes(a ^ b)), radius))[: len(a)]


def near_in(queries: np.ndarray, others: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of queries and others that are within the radius, some queries against all others at a time."""
    stored, found = planes(others), []
    for at in range(0, len(queries), 64):
        own = queries[at : at + 64]
        flip = ((own[None, :] >> np.arange(64, dtype=np.uint64)[:, None]) & np.uint64(1)) * ONES
        near = within((stored[bit][None, :] ^ flip[bit][:, None] for bit in range(64)), radius)
        q, o = np.nonzero(lanes(near)[:, : len(others)])
        found.append((q + at, o))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Spanning links of the nodes that meet: each node with the first of those it reaches in its tile pair."""
    for table, bounds in runs(batches, ["key", "tile_a", "tile_b"]):
        prints, tile = table["fp"].to_numpy(), table["tile"].to_numpy()
        unsigned, sizes = prints.view(np.uint64), np.diff(bounds)
        a, b = [], []
        for size in np.unique(sizes[(sizes > 1) & (sizes <= SMALL)]):
            starts = bounds[:-1][sizes == size]
            for at in range(0, len(starts), 20_000):
                i, j = (starts[at : at + 20_000, None] + k for k in np.triu_indices(size, 1))
                i, j = i.ravel(), j.ravel()
                near = near_pairs(unsigned[i], unsigned[j], radius)
                a.append(i[near])
                b.append(j[near])
        for start, size in zip(bounds[:-1][sizes > SMALL], sizes[sizes > SMALL], strict=True):
            own = np.arange(start, start + size)
            first = own[tile[own] == tile[own].min()]
            rest = own[tile[own] != tile[own].min()]
            i, j = near_in(unsigned[first], unsigned[rest if len(rest) else first], radius)
            a.append(first[i])
            b.append((rest if len(rest) else first)[j])
        if not a:
            continue
        a, b = np.concatenate(a), np.concatenate(b)
        linked = np.unique(np.concatenate([a, b]))
        root = linked[roots(len(linked), np.searchsorted(linked, a), np.searchsorted(linked, b))]
        far = prints[linked] != prints[root]
        yield pa.RecordBatch.from_arrays([pa.array(prints[root[far]]), pa.array(prints[linked[far]])], ["a", "b"])


def links(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Spanning links ``a``-``b`` of distinct fingerprints ``fp``; every pair within the radius is connected."""
    keys = nodes.select("fp", F.explode(F.array(*meeting_keys(radius))).alias("key"))
    met = keys.groupBy("key").count().where("count > 1")
    tiles = F.ceil(F.col("count") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
    placed = keys.join(met, "key").select("key", "fp", tiles.alias("tiles"), own.alias("tile"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    placed = placed.select("key", "fp", "tile", other)
    ends = F.least("tile", "other").alias("tile_a"), F.greatest("tile", "other").alias("tile_b")
    dealt = placed.select("key", *ends, "tile", "fp").repartition("key", "tile_a", "tile_b")
    ordered = dealt.sortWithinPartitions("key", "tile_a", "tile_b")
    return ordered.mapInArrow(partial(_links, radius=radius), "a long, b long")


def groups(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp, component_id) of every row; the component's id is the smallest ``doc_id`` in it."""
    text = F.col(f"`{text_col}`").cast("string")
    prints = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), fingerprint_of(text, shingle).alias("fp"))
    prints = materialise(prints, "fingerprints")
    rows = prints.count()
    nodes = materialise(in_few_files(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), rows), "nodes")
    linked = _linked(nodes, radius)
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    linked = linked.join(least, "root").select("fp", "least")
    named = nodes.join(linked, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return prints.join(materialise(in_few_files(named, rows), "named"), "fp").select("doc_id", "fp", "component_id")


def _linked(nodes: DataFrame, radius: int) -> DataFrame:
    """The nodes that have links, with the ``root`` of their component, one of its fingerprints."""
    return nodes.join(components(links(nodes, radius)).select(F.col("node").alias("fp"), "root"), "fp")


def deduplicate(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component with all its columns: the first row by id, null last.

    Rows are told apart by their file and place, whether they share an id or have none, and ids don't decide what is a
    duplicate. Texts are read and never shuffled: the places of the rows to drop are written down, sorted by file, and
    the task that reads a file looks its own ones up.
    """
    docs, file, place = located(docs)
    print_of = fingerprint_of(F.col(f"`{text_col}`").cast("string"), shingle)
    own_id = F.col(f"`{id_col}`").cast("long").alias("id")
    prints = materialise(docs.select(print_of.alias("fp"), own_id, file, place), "fingerprints")
    row = F.struct(F.col("id").isNull().alias("no_id"), "id", "file", "place")
    nodes = materialise(prints.groupBy("fp").agg(F.min(row).alias("first")), "nodes")
    linked = _linked(nodes, radius).select("fp", "root")
    root = F.coalesce("root", "fp").alias("root")
    kept = nodes.join(linked, "fp", "left").groupBy(root).agg(F.min("first").alias("first"))
    kept = materialise(kept.select("first.file", "first.place"), "kept")
    dropped = prints.select("file", "place").join(kept, ["file", "place"], "left_anti")
    return docs.where(~_among(SideFiles(dropped, prints.count(), "dropped"), file, place))


def _among(sides: SideFiles, file: Column, place: Column) -> Column:
    """Whether a row's place is in the side files."""

    @F.arrow_udf(T.BooleanType())
    def found(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for files, places in batches:
            own, at = files.to_numpy(), places.to_numpy()
            hit = np.zeros(len(own), bool)
            for number in np.unique(own).tolist():
                mine = own == number
                table = sides.of(number, at[mine], "place")
                if table is not None:
                    hit[mine] = np.isin(at[mine], table["place"].to_numpy())
            yield pa.array(hit)

    return found(file, place)
