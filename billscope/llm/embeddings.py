"""Embedding near-duplicates: spherical k-means cells, blocked cosine products inside them.

Vectors are compared only within one label and one length. Equal unit vectors are one node. Centres are fitted to
a bounded sample; every node is at home in the cell of its nearest centre and visits the ``visits`` cells of its
nearest centres, its home among them, except those in which no vector within the threshold can be at home: with ``t``
the angle of the threshold, x can only have such a neighbour at home in cell c if
``x . (home - c) <= sin(t) * |home - c|``. So the work grows with the vectors, and nearly all links are found (README
has the measured recall); with ``visits=None`` a node visits every cell that may hold a neighbour and no link is lost,
which on vectors without clusters is nearly every cell. A node asks the nodes that visit its home: a link that only one
of the two finds counts for that one, and joins both. Cells are cut into tiles, and a task multiplies one tile of nodes
at home with one tile of nodes of the cell: first in single precision, then, near the threshold, in double.

Nodes are told apart by a 64-bit hash of label and unit vector.

Vectors that are null, empty or zero, or hold a null or a number that isn't finite, and vectors without a label,
link with nothing. Rows with the same vector and label link with each other, also where they share an id or
have none. Rows without an id count as links; their own component is null unless a row of it has an id. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.llm.components import components
from billscope.llm.groups import roots, runs
from billscope.work import materialise

THRESHOLD = 0.93
SAMPLE, SAMPLE_BYTES = 20_000, 64_000_000  # vectors, and bytes of them, at most, to which centres are fitted
CELL = 1_000  # nodes a cell is meant to have
MOST_CENTRES = 4_096  # beyond as many cells they grow with the data
VISITS = 4
STEPS = 8
TILE = 2_048
SLACK = 1e-4  # by which single precision may err


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors at unit length as bytes of doubles; null where a vector can't be compared."""
    for batch in batches:
        vectors, units, sizes = batch.column(1), [], []
        values, offsets = np.asarray(vectors.values.cast(pa.float64()).fill_null(np.nan)), np.asarray(vectors.offsets)
        known = np.asarray(vectors.is_valid())
        for n in range(len(vectors)):
            own = values[offsets[n] : offsets[n + 1]]
            with np.errstate(all="ignore"):
                top = np.abs(own).max(initial=0)
                scaled = own / top if np.isfinite(top) and top > 0 else own * np.nan
                unit = scaled / np.sqrt(scaled @ scaled) + 0.0
            fit = known[n] and len(own) > 0 and np.isfinite(unit).all()
            units.append(unit.tobytes() if fit else None)
            sizes.append(len(own) if fit else None)
        arrays = [batch.column(0), batch.column(2), pa.array(sizes, pa.int32()), pa.array(units, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "size", "unit"])


def fit(units: np.ndarray, count: int, seed: int = 5) -> np.ndarray:
    """Centres of a spherical k-means, at unit length."""
    rng = np.random.default_rng(seed)
    centres = units[rng.choice(len(units), min(count, len(units)), replace=False)]
    for _ in range(STEPS):
        home = (units @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, units)
        sizes = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(sizes > 1e-12, sums / np.where(sizes == 0, 1, sizes), centres)
    return centres


def _cells(
    batches: Iterator[pa.RecordBatch], centres: np.ndarray, threshold: float, most: int | None
) -> Iterator[pa.RecordBatch]:
    """Each node once for its own cell and once for each of the ``most`` nearest where a neighbour may be at home."""
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2)
    reach = math.sqrt(max(0.0, 1 - threshold * threshold)) * apart + 1e-9
    for whole in batches:
        for at in range(0, whole.num_rows, 2_000):
            batch = whole.slice(at, 2_000)
            sizes = batch.column(3).to_numpy()
            fits = np.flatnonzero(sizes == centres.shape[1]) if len(centres) else np.empty(0, np.int64)
            rest = np.setdiff1d(np.arange(batch.num_rows), fits)
            row, cell, home = [rest], [np.zeros(len(rest), np.int64)], [np.ones(len(rest), bool)]
            if len(fits):
                data = batch.column(4).to_pylist()
                units = np.frombuffer(b"".join([data[n] for n in fits]), "<f8").reshape(len(fits), -1)
                near = units @ centres.T
                own = near.argmax(1)
                lead = near[np.arange(len(fits)), own][:, None] - near
                visits = lead <= reach[own]
                if most is not None and most < len(centres):
                    last = np.partition(lead, most - 1, axis=1)[:, most - 1 : most]
                    visits &= lead <= last
                which, where = np.nonzero(visits)
                row.append(fits[which])
                cell.append(where)
                home.append(where == own[which])
            taken = batch.take(pa.array(np.concatenate(row)))
            arrays = [pa.array(np.concatenate(cell), pa.int32()), pa.array(np.concatenate(home))]
            yield pa.RecordBatch.from_arrays([*taken.columns, *arrays], [*taken.schema.names, "cell", "home"])


def _neighbours(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """For each node with a neighbour in a pair of tiles: rows it links with, and the first node it reaches."""
    for table, bounds in runs(batches, ["key", "own_tile", "other_tile"]):
        node, copies, asks = (table[name].to_numpy(zero_copy_only=False) for name in ("node", "copies", "asks"))
        data = table["unit"].to_pylist()
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            mine = np.flatnonzero(asks[start:end]) + start
            others = np.flatnonzero(~asks[start:end]) + start
            if not len(mine) or not len(others):
                continue
            x, y = (np.frombuffer(b"".join([data[n] for n in rows]), "<f8").reshape(len(rows), -1) for rows in (mine, others))
            cosines = x.astype(np.float32) @ y.astype(np.float32).T
            i, j = np.nonzero(cosines >= threshold - SLACK)
            sure = cosines[i, j] >= threshold + SLACK
            for at in range(0, len(i), 100_000):
                doubt = np.flatnonzero(~sure[at : at + 100_000]) + at
                sure[doubt] = np.einsum("nd,nd->n", x[i[doubt]], y[j[doubt]]) >= threshold
            i, j = i[sure], j[sure]
            other = node[mine[i]] != node[others[j]]
            i, j = i[other], j[other]
            if not len(i):
                continue
            nodes = np.concatenate([node[mine], node[others]])
            distinct, place = np.unique(nodes, return_inverse=True)
            a, b = place[: len(mine)][i], place[len(mine) :][j]
            links = np.bincount(a, weights=copies[others[j]], minlength=len(distinct)).astype(np.int64)
            root = roots(len(distinct), a, b)
            touched = np.unique(np.concatenate([a, b]))
            arrays = [distinct[touched], distinct[root[touched]], links[touched]]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in arrays], ["a", "b", "links"])


def _tiled(cells: DataFrame, tile: int) -> DataFrame:
    """Rows of the pairs of tiles of every cell; a node at home asks, every node of the cell answers."""
    sizes = cells.groupBy("key").agg(F.count("*").alias("others"), F.sum(F.col("home").cast("long")).alias("homes"))
    sizes = sizes.where("others > 1 and homes > 0").select(
        "key", F.ceil(F.col("homes") / tile).cast("int").alias("own_tiles"), F.ceil(F.col("others") / tile).cast("int").alias("other_tiles")
    )
    placed = cells.join(sizes, "key")
    spread = F.xxhash64("node")

    def every(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    columns = ["node", "copies", "unit"]
    own = F.pmod(spread, F.col("own_tiles")).cast("int").alias("own_tile")
    asks = placed.where("home").select("key", own, every("other_tiles").alias("other_tile"), F.lit(True).alias("asks"), *columns)
    other = F.pmod(spread, F.col("other_tiles")).cast("int").alias("other_tile")
    answers = placed.select("key", every("own_tiles").alias("own_tile"), other, F.lit(False).alias("asks"), *columns)
    keys = "key", "own_tile", "other_tile"
    return asks.unionByName(answers).repartition(*keys).sortWithinPartitions(*keys)


def groups(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    sample: int = SAMPLE,
    cell: int = CELL,
    tile: int = TILE,
    visits: int | None = VISITS,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest id it reaches, its own included), kept."""
    if not 0 < threshold < 1 or visits is not None and visits < 1:
        raise ValueError("the threshold lies between 0 and 1, and there is a visit at least")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
    )
    units = rows.mapInArrow(_units, "vec_id long, label string, size int, unit binary")
    units = units.withColumn("unit", F.when(F.col("label").isNotNull(), F.col("unit")))
    node = F.when(F.col("unit").isNotNull(), F.xxhash64("label", "unit"))
    units = materialise(units.withColumn("node", node), "units")
    grouped = units.where("unit is not null").groupBy("node", "label", "size", "unit")
    nodes = grouped.agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = materialise(nodes.select("node", "copies", "label", "size", "unit", "first"), "nodes")
    return _named(units, nodes, _linked(nodes, threshold, sample, cell, tile, visits))


def _linked(nodes: DataFrame, threshold: float, sample: int, cell: int, tile: int, visits: int | None) -> DataFrame:
    """(a, b, links): links of node ``a`` found in a pair of tiles, and a node ``b`` it is connected with."""
    sizes = nodes.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    centres = np.empty((0, 1))
    if sizes:
        sample = max(1, min(sample, SAMPLE_BYTES // (8 * sizes["size"])))
        share = math.ceil(1_000_000 * min(1.0, 2 * sample / sizes["count"]))
        chosen = nodes.where((F.col("size") == sizes["size"]) & (F.pmod("node", F.lit(1_000_000)) < share))
        chosen = [bytes(row[0]) for row in chosen.select("unit", "node").orderBy("node").limit(sample).collect()]
        if chosen:
            units = np.frombuffer(b"".join(chosen), "<f8").reshape(len(chosen), -1)
            centres = fit(units, max(1, min(MOST_CENTRES, math.ceil(sizes["count"] / cell))))
    schema = "node long, copies long, label string, size int, unit binary, cell int, home boolean"
    placed = nodes.drop("first").mapInArrow(partial(_cells, centres=centres, threshold=threshold, most=visits), schema)
    key = F.xxhash64("label", "size", "cell").alias("key")
    placed = materialise(placed.select(key, "node", "copies", "home", "unit"), "cells")
    found = _tiled(placed, tile).mapInArrow(partial(_neighbours, threshold=threshold), "a long, b long, links long")
    return materialise(found, "neighbours")


def _named(units: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    whole = nodes.select("node", "first", "copies").join(components(found), "node", "left")
    whole = whole.withColumn("root", F.coalesce("root", "node")).join(counts, "node", "left")
    least = whole.groupBy("root").agg(F.min("first").alias("least"))
    links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    named = whole.join(least, "root").select("node", links.alias("n_links"), "least")
    joined = units.select("vec_id", "node").join(materialise(named, "named"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
