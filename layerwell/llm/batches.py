"""Groups of consecutive rows in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree in the first ``keys`` columns, across batches."""
    held: list[pa.RecordBatch] = []
    name = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for first, last in zip(cuts[:-1], cuts[1:]):
            if first == last:
                continue
            now = tuple(c[first] for c in columns)
            if held and now != name:
                yield pa.Table.from_batches(held)
                held = []
            name = now
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)
