"""Streaming over groups of rows from partitions that are sorted by the group's key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Key and rows of every run of equal values in the first ``keys`` columns; they must be numbers without nulls.

    Only the rows of one group are held.
    """
    name, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            this = tuple(c[a].item() for c in columns)
            if this != name and parts:
                yield name, pa.Table.from_batches(parts)
                parts = []
            name = this
            parts.append(batch.slice(a, b - a))
    if parts:
        yield name, pa.Table.from_batches(parts)
