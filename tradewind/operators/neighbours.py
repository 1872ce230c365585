"""Exact nearest neighbours in a k-d partition.

A k-d tree of medians, made from a bounded sample, deals the rows to blocks; every split is along the column that spreads most
in its part, so blocks are about as wide in all columns that matter. In the first pass each row finds its k nearest inside its
own block; the k-th distance bounds what others could improve. Only the blocks whose boxes are nearer than that are asked in the
second pass, row by row, and their answers are merged. The result is that of all pairs. As rows grow, blocks shrink and a
row asks about as many blocks as before, so the share of rows and blocks that meet falls.

A row with a value that is not a number is at the same, greatest distance from all others."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stages import materialize

#: Rows that are compared at once with a block; rows in the sample that the tree is made from; blocks at most, as their boxes are sent out.
CHUNK, SAMPLE, MOST_BLOCKS = 500, 50_000, 100_000
#: The distance to a row with a value that is not a number: beyond all others.
UNKNOWN = np.finfo(np.float64).max
BLOCK = "block long, places binary, vectors binary, low array<double>, high array<double>"
FOUND = "place long, near array<struct<gap: double, at: array<double>>>"


class Tree:
    """Splits of a k-d tree by rows of four arrays: column (-1: a leaf), value, and the two children."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.column, self.value, self.left, self.right = [], [], [], []
        self._grow(points, leaves)
        self.column, self.value, self.left, self.right = (np.array(x) for x in (self.column, self.value, self.left, self.right))

    def _grow(self, points: np.ndarray, leaves: int) -> int:
        node = len(self.column)
        for part, x in ((self.column, -1), (self.value, 0.0), (self.left, -1), (self.right, -1)):
            part.append(x)
        if leaves < 2 or len(points) < 2:
            return node
        spread = points.std(0)
        c = int(spread.argmax())
        split = float(np.median(points[:, c]))
        below = points[:, c] <= split
        if below.all():  # the median is the greatest value: it goes above
            split = float(np.nextafter(split, -np.inf))
            below = points[:, c] <= split
        if not spread[c] > 0 or below.all() or not below.any():
            return node
        self.column[node], self.value[node] = c, split
        self.left[node] = self._grow(points[below], leaves // 2)
        self.right[node] = self._grow(points[~below], leaves - leaves // 2)
        return node

    def leaf(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point, -1 for points with a value that is not a number."""
        node = np.zeros(len(points), np.int64)
        while (inner := self.column[node] >= 0).any():
            own = node[inner]
            below = points[inner, self.column[own]] <= self.value[own]
            node[inner] = np.where(below, self.left[own], self.right[own])
        node[np.isnan(points).any(1)] = -1
        return node


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _leaves(batches: Iterator[pa.RecordBatch], tree: Broadcast, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("leaf", pa.array(tree.value.leaf(_vectors(batch.column("at"), width))))


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows of whole blocks, which arrive sorted, as one row each with its box."""
    held: list[pa.RecordBatch] = []

    def packed() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        own = _vectors(table.column("at").combine_chunks(), width)
        values = [[table.column("block")[0].as_py()], [table.column("place").to_numpy().tobytes()], [own.tobytes()], [own.min(0).tolist()], [own.max(0).tolist()]]
        types = (pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()))
        return pa.record_batch([pa.array(x, t) for x, t in zip(values, types, strict=True)], names=["block", "places", "vectors", "low", "high"])

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist()] if len(blocks) else []
        for first, last in zip(starts, [*starts[1:], len(blocks)], strict=True):
            if held and held[0].column("block")[0].as_py() != blocks[first]:
                yield packed()
                held.clear()
            held.append(batch.slice(first, last - first))
    if held:
        yield packed()


def _nearest(rows: np.ndarray, block: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distances (squared) to the up to k nearest of a block, and where they are in it; ``own`` is each row's place in it."""
    k = min(k, len(block))
    gaps = np.zeros((len(rows), len(block)))
    for c in range(block.shape[1]):
        gaps += (rows[:, c, None] - block[None, :, c]) ** 2
    gaps[np.isnan(gaps)] = UNKNOWN
    if own is not None:
        gaps[np.arange(len(rows)), own] = np.inf
    near = np.argpartition(gaps, k - 1, axis=1)[:, :k]
    return np.take_along_axis(gaps, near, 1), near


def _box_gaps(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least squared distance of each row to each box; a box with a side that is not a number is at the greatest."""
    out = np.zeros((len(rows), len(low)))
    for c in range(rows.shape[1]):
        out += np.maximum(np.maximum(low[None, :, c] - rows[:, c, None], rows[:, c, None] - high[None, :, c]), 0) ** 2
    out[np.isnan(out)] = UNKNOWN
    return out


def _answer(places: np.ndarray, gaps: np.ndarray, at: list[np.ndarray]) -> pa.RecordBatch:
    """A row for each place with the near rows among ``gaps`` that are below infinity."""
    there = gaps < np.inf
    ends = np.append(0, np.cumsum(there.sum(1))).astype(np.int32)
    flat = np.concatenate([a[t] for a, t in zip(at, there, strict=True)]) if len(places) else np.zeros((0, 1))
    width = flat.shape[1]
    vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1, dtype=np.int32) * width), pa.array(flat.reshape(-1)))
    near = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(gaps[there]), vectors], ["gap", "at"]))
    return pa.record_batch([pa.array(places), near], names=["place", "near"])


def _first(batches: Iterator[pa.RecordBatch], boxes: Broadcast, k: int, width: int) -> Iterator[pa.RecordBatch]:
    """Inside each block: the nearest of each row, its bound, and the other blocks that could hold nearer ones."""
    numbers, low, high = boxes.value
    for batch in batches:
        for block, places, vectors in zip(*(batch.column(c).to_pylist() for c in ("block", "places", "vectors")), strict=True):
            own, places = np.frombuffer(vectors).reshape(-1, width), np.frombuffer(places, np.int64)
            for at in range(0, len(own), CHUNK):
                rows = own[at : at + CHUNK]
                gaps, near = _nearest(rows, own, k, np.arange(at, at + len(rows)))
                bound = gaps.max(1) if gaps.shape[1] == k else np.full(len(rows), np.inf)
                # Blocks near enough to the box of the rows, then row by row.
                apart = np.maximum(np.maximum(low - rows.max(0), rows.min(0) - high), 0)
                close = np.flatnonzero(~((apart**2).sum(1) >= bound.max()))
                asked = (_box_gaps(rows, low[close], high[close]) < bound[:, None]) & (numbers[close] != block)[None, :]
                out = _answer(places[at : at + len(rows)], gaps, [own[x] for x in near])
                visits = [numbers[close[x]].tolist() for x in asked]
                yield out.append_column("at", pa.array(rows.tolist(), pa.list_(pa.float64()))).append_column("bound", pa.array(bound)).append_column("visits", pa.array(visits, pa.list_(pa.int64())))


def _second(batches: Iterator[pa.RecordBatch], k: int, width: int) -> Iterator[pa.RecordBatch]:
    """The answers of each block, which arrives first and then the rows that ask it."""
    block = np.zeros((0, width))
    for batch in batches:
        vectors = batch.column("vectors")
        marks = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False)).tolist()
        for first, last in zip([0, *marks], [*marks, batch.num_rows], strict=True):
            if first in marks:
                block, first = np.frombuffer(vectors[first].as_py()).reshape(-1, width), first + 1
            for at in range(first, last, CHUNK):
                part = batch.slice(at, min(CHUNK, last - at))
                gaps, near = _nearest(_vectors(part.column("at"), width), block, k)
                gaps[gaps >= part.column("bound").to_numpy()[:, None]] = np.inf
                yield _answer(part.column("place").to_numpy(), gaps, [block[x] for x in near])


def partition(rows: DataFrame, cols: list[str], block: int) -> tuple[DataFrame, DataFrame]:
    """``[place, key, at, block]`` of all rows, and the blocks with their boxes; both written."""
    values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols])
    lined = materialize(rows.select(F.monotonically_increasing_id().alias("place"), "key", values.alias("at")))
    count = lined.count()
    block = max(block, -(-count // MOST_BLOCKS))
    drawn = lined.select("at").where(F.xxhash64("key", "place") % max(1, -(-count // SAMPLE)) == 0).collect() if count else []
    points = np.array([r["at"] for r in drawn], np.float64).reshape(-1, len(cols))
    tree = rows.sparkSession.sparkContext.broadcast(Tree(points[np.isfinite(points).all(1)], -(-count // block)))
    dealt = lined.mapInArrow(partial(_leaves, tree=tree, width=len(cols)), "place long, key string, at array<double>, leaf long")
    dealt = materialize(dealt)
    # A leaf that grew beyond a block (equal rows cannot be split) is dealt to several by hash.
    parts = dealt.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    own = dealt.join(parts, "leaf").select("place", "key", "at", (F.col("leaf") * 1_000_000 + F.pmod(F.xxhash64("key", "place"), F.col("parts"))).alias("block"))
    ordered = own.repartition(max(1, -(-count // block)), "block").sortWithinPartitions("block", "place")
    return lined, materialize(ordered.mapInArrow(partial(_blocks, width=len(cols)), BLOCK))


def first_pass(blocks: DataFrame, k: int, width: int) -> DataFrame:
    """``[place, near, at, bound, visits]`` of all rows, written."""
    boxes = blocks.select("block", "low", "high").collect()  # at most about MOST_BLOCKS
    low, high = (np.array([r[c] for r in boxes], np.float64).reshape(-1, width) for c in ("low", "high"))
    sent = blocks.sparkSession.sparkContext.broadcast((np.array([r.block for r in boxes], np.int64), low, high))
    return materialize(blocks.mapInArrow(partial(_first, boxes=sent, k=k, width=width), FOUND + ", at array<double>, bound double, visits array<long>"))


def nearest_rows(rows: DataFrame, cols: list[str], k: int, block: int) -> DataFrame:
    """``[key, at, others]``: each row's ``cols`` as an array, and those of its k nearest other rows one after another, for
    rows with a text ``key``. A task holds one block of about ``block`` rows."""
    lined, blocks = partition(rows, cols, block)
    first = first_pass(blocks, k, len(cols))
    asking = first.select(F.explode("visits").alias("block"), "place", "at", "bound")
    both = asking.unionByName(blocks.select("block", "vectors"), allowMissingColumns=True)
    # Blocks before rows: their place is null.
    both = both.repartition("block").sortWithinPartitions("block", F.col("place").asc_nulls_first())
    second = both.select("place", "at", "bound", "vectors").mapInArrow(partial(_second, k=k, width=len(cols)), FOUND)
    merged = first.select("place", "near").unionByName(second).groupBy("place").agg(F.flatten(F.collect_list("near")).alias("near"))
    best = F.slice(F.array_sort("near"), 1, k)
    return lined.join(merged, "place").select("key", "at", F.flatten(F.transform(best, lambda x: x["at"])).alias("others"))
