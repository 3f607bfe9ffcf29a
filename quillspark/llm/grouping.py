"""Groups of rows in Arrow batches that are sorted by their key, and connected groups inside one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def sorted_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Every group of the keys, which must be bounded, whole in one partition and in one run of rows."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int = 1) -> Iterator[pa.Table]:
    """Batches sorted by their first columns -> one table a group. A group may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1
        edges = [0, *change.tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if last is not None and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def linked_groups(m: int, similar) -> list[np.ndarray]:
    """Connected groups of 0..m-1 under similar(i, candidates) -> mask. What is in a group isn't compared again."""
    todo, out = np.arange(m), []
    while len(todo):
        group, frontier, rest = [todo[0]], [todo[0]], todo[1:]
        while frontier and len(rest):
            hit = similar(frontier.pop(), rest)
            new = rest[hit].tolist()
            rest = rest[~hit]
            group += new
            frontier += new
        out.append(np.array(group))
        todo = rest
    return out
