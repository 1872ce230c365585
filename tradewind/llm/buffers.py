"""Many texts as one byte array, and array arithmetic on it.

The operators read Arrow batches, cut them into slices of a bounded number of bytes and work on each
slice with whole-array operations, so that memory depends on the slice and on the longest single text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}

#: The six ASCII white-space bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hashes`` takes the hash of any span of ``data``."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the bytes [start, end): equal bytes have equal hashes anywhere."""
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a column without nulls, and the offsets of each value."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]] if values else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, nulls empty, and the offsets of each text."""
    return joined_bytes(pc.fill_null(column, ""))


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows with about ``limit`` bytes of text (one row may have more): rows, bytes, offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
            yield batch.slice(first, last - first), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
            first = last


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each text (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = word.copy()
    begins[1:] &= ~word[:-1] | edge[1:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def span_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between neighbouring bounds; empty ranges give 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[bounds])


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each element of consecutive ranges, the number of its range."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one range after the other."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    shift = np.repeat(np.asarray(starts, np.int64) - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total, dtype=np.int64) + shift
