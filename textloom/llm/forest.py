"""Sorted groups of rows inside one task, and joining sets of them by array arithmetic."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa


def joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the links between the places ``a`` and ``b``; ``parent`` holds the root of every place.

    The smallest place of a set is its root.
    """
    while len(a):
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        parent = parent.copy()
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            above = parent[parent]
            if (above == parent).all():
                break
            parent = above
    return parent


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups, and where each group begins and the last one ends.

    Rows of a group stand together; the last group of a batch may go on in the next one.
    """
    held: list[pa.Table] = []

    def turns(table: pa.Table) -> np.ndarray:
        turn = np.zeros(max(0, table.num_rows - 1), bool)
        for k in keys:
            v = table.column(k).to_numpy()
            turn |= v[1:] != v[:-1]
        return np.flatnonzero(turn) + 1

    def finish() -> tuple[pa.Table, list[int]]:
        table = pa.concat_tables(held).combine_chunks()
        held.clear()
        return table, [0, *turns(table).tolist(), table.num_rows]

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if held and any(held[-1].column(k)[-1].as_py() != table.column(k)[0].as_py() for k in keys):
            yield finish()
        at = turns(table)
        if len(at):
            held.append(table.slice(0, int(at[-1])))
            yield finish()
            table = table.slice(int(at[-1]))
        held.append(table)
    if held:
        yield finish()
