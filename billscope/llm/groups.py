"""Sorted rows of a partition as runs of equal keys, for tasks that work group by group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the groups' bounds; one group is held at a time beyond a batch.

    The rows come sorted by ``keys``, which are integers without nulls.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        bounds = _bounds(table, keys)
        if len(bounds) > 2:
            last = int(bounds[-2])
            yield table.slice(0, last), bounds[:-1]
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, _bounds(table, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table[key].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def roots(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member reachable from each of ``count`` nodes by the links ``a``-``b``."""
    root = np.arange(count)
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, least)
        np.minimum.at(root, b, least)
        root = root[root]
        if (root == before).all():
            return root
