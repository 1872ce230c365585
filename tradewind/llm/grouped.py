"""Streaming over sorted partitions: whole groups of rows, without one Python call per group in Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """First row of every run of equal integer keys, and the number of rows at the end."""
    n = table.num_rows
    change = np.zeros(n, bool)
    if n:
        change[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), n)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables made of complete groups only (rows arrive sorted by ``keys``), with their group starts.

    What is held is one Arrow batch and the group that is still open."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = group_starts(pa.Table.from_batches([batch]), keys)[-2]
        if last == 0:
            first = held[0]
            if all(first.column(k)[0] == batch.column(k)[0] for k in keys):
                continue
        done = pa.Table.from_batches([*held[:-1], batch.slice(0, last)])
        held = [batch.slice(last)]
        yield done, group_starts(done, keys)
    if held:
        done = pa.Table.from_batches(held)
        yield done, group_starts(done, keys)


def binary_rows(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The bytes of each value."""
    return [np.frombuffer(x.as_buffer(), np.uint8) for x in column]
