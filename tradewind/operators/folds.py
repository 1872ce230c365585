"""Models that are fitted on all folds of a comparison at once.

Rows lie in blocks with their fold. A job goes over all blocks and returns sums for every fold: a row counts for each fold but its
own. So k folds take the jobs of one, and what the driver holds does not grow with the rows: sums of each task, weights, trees.

Linear models have the losses of MLlib's without a penalty (logistic, hinge). Each fold follows its own L-BFGS; a job tries all step
lengths of all folds, so an iteration is one job. Boosted trees are those of ``boosting``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stages import materialize
from .boosting import BINS, ROWS, Tree, _advanced, _binned, _split, cut_points

#: Step lengths that one job tries; vectors that L-BFGS remembers; rows scored at a time, for all folds and steps; trees between two writes of the margins.
STEPS, MEMORY, SLICE, RENEW = 2.0 ** np.arange(3, -10, -1), 10, 4096, 4
BLOCKS = "x binary, y binary, fold binary, f binary"


def _rows(data: DataFrame) -> DataFrame:
    return data.select(vector_to_array("features").alias("x"), F.col("label").alias("y"), F.col("fold").cast("long").alias("fold"))


def _packed(batches: Iterator[pa.RecordBatch], shape: Callable[[np.ndarray], np.ndarray], folds: int) -> Iterator[pa.RecordBatch]:
    """Blocks of rows: ``shape`` of their features, a row per feature; classes as -1 and 1; folds; a margin of zero for each fold."""
    held, size = [], 0

    def block() -> pa.RecordBatch:
        x, y, fold = (np.concatenate(p, axis=-1) for p in zip(*held))
        cells = [x.tobytes(), y.tobytes(), fold.tobytes(), np.zeros((folds, len(y))).tobytes()]
        return pa.record_batch([pa.array([c], pa.binary()) for c in cells], names=["x", "y", "fold", "f"])

    for batch in batches:
        if not batch.num_rows:
            continue
        y, fold = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
        held.append((shape(batch.column("x").flatten().to_numpy(zero_copy_only=False)), np.where(y > 0, 1, -1).astype(np.int8), fold.astype(np.int32)))
        size += len(y)
        if size >= ROWS:
            yield block()
            held, size = [], 0
    if held:
        yield block()


def _blocks(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for x, y, fold, f in zip(*[batch.column(c) for c in ("x", "y", "fold", "f")]):
            y = np.frombuffer(y.as_buffer(), np.int8)
            f = np.frombuffer(f.as_buffer(), np.float64).reshape(-1, len(y))
            yield np.frombuffer(x.as_buffer(), kind).reshape(-1, len(y)), y, np.frombuffer(fold.as_buffer(), np.int32), f


def _summed(blocks: DataFrame, job: Callable) -> np.ndarray:
    """The sum of what ``job`` returns for each task."""
    return sum(np.frombuffer(r.sums, np.float64) for r in blocks.mapInArrow(job, "sums binary").collect())


def _cell(sums: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([sums.tobytes()], pa.binary())], names=["sums"])


def _right(batches: Iterator[pa.RecordBatch], kind: type, folds: int, margins: Callable) -> Iterator[pa.RecordBatch]:
    """Rows of each fold, and those that the fold's own model gets right; ``margins`` of a block and a fold's model."""
    sums = np.zeros((folds, 2))
    for x, y, fold, f in _blocks(batches, kind):
        for k in range(folds):
            own = fold == k
            hits = (margins(x[:, own], f[k, own] if len(f) else None, k) > 0) == (y[own] > 0)
            sums[k] += len(hits), hits.sum()
    yield _cell(sums)


def _accuracies(blocks: DataFrame, kind: type, folds: int, margins: Callable) -> list[float | None]:
    sums = _summed(blocks, partial(_right, kind=kind, folds=folds, margins=margins)).reshape(folds, 2)
    return [hits / n if n else None for n, hits in sums.tolist()]


# linear models


def _losses(batches: Iterator[pa.RecordBatch], loss: str, points: np.ndarray) -> Iterator[pa.RecordBatch]:
    """By fold and point: rows, loss and its gradient, the last for the constant. ``points``: fold x point x (features + 1)."""
    folds, tries, width = points.shape
    sums = np.zeros((folds, tries, width + 2))
    for x, y, fold, _ in _blocks(batches, np.float64):
        for start in range(0, len(y), SLICE):
            own = slice(start, start + SLICE)
            z = np.concatenate([x[:, own], np.ones((1, len(y[own])))])
            for k in range(folds):
                at = np.flatnonzero(fold[own] != k)
                zk, yk = z[:, at], y[own][at].astype(float)
                m = (points[k] @ zk) * yk
                if loss == "hinge":
                    value, slope = np.maximum(1 - m, 0), -(m < 1).astype(float)
                else:
                    e = np.exp(-np.abs(m))
                    value, slope = np.maximum(-m, 0) + np.log1p(e), -np.where(m > 0, e, 1) / (1 + e)
                sums[k, :, 0] += len(yk)
                sums[k, :, 1] += value.sum(1)
                sums[k, :, 2:] += (slope * yk) @ zk.T
    yield _cell(sums)


def _direction(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Where L-BFGS goes from a gradient, by its last steps and what they changed."""
    q, kept = g.copy(), []
    for s, d in reversed(pairs):
        a = s @ q / (s @ d)
        q -= a * d
        kept.append(a)
    q *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1 / max(1.0, float(np.linalg.norm(g)))
    for (s, d), a in zip(pairs, reversed(kept)):
        q += s * (a - d @ q / (s @ d))
    return -q


def minimise(evaluate: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], folds: int, width: int, rounds: int, tolerance: float) -> np.ndarray:
    """The least point of each fold's function. ``evaluate`` gives values and gradients at fold x point x width. A fold is done when a
    step gains less than ``tolerance`` of its value, or when no step gains anything, not even straight down."""
    at = np.zeros((folds, width))
    value, slope = (v[:, 0] for v in evaluate(at[:, None]))
    pairs: list[list] = [[] for _ in range(folds)]
    going = list(range(folds))
    for _ in range(rounds):
        if not going:
            break
        to = np.zeros((folds, width))
        for k in going:
            to[k] = _direction(slope[k], pairs[k])
        points = at[:, None] + STEPS[None, :, None] * to[:, None]
        values, slopes = evaluate(points)
        for k in list(going):
            best = int(np.nanargmin(values[k]))
            gain = value[k] - values[k, best]
            if not gain > tolerance * max(abs(value[k]), tolerance):
                if not pairs[k]:
                    going.remove(k)
                pairs[k] = []
            if gain > 0:
                step, change = points[k, best] - at[k], slopes[k, best] - slope[k]
                if step @ change > 1e-12 * (step @ step):
                    pairs[k] = [*pairs[k], (step, change)][-MEMORY:]
                at[k], value[k], slope[k] = points[k, best], values[k, best], slopes[k, best]
    return at


def _scaled(flat: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return (flat.reshape(-1, len(mean)).T - mean[:, None]) / spread[:, None]


def _linear(x: np.ndarray, f: None, k: int, weights: np.ndarray) -> np.ndarray:
    return weights[k, :-1] @ x + weights[k, -1]


@dataclass
class FoldLinear:
    """Linear models by ``loss``: logistic or hinge."""

    loss: str
    rounds: int = 100
    tolerance: float = 1e-6

    def accuracies(self, data: DataFrame, folds: int) -> list[float | None]:
        blocks, width = self.blocks(data, folds)
        return _accuracies(blocks, np.float64, folds, partial(_linear, weights=self.fit(blocks, width, folds)))

    def blocks(self, data: DataFrame, folds: int) -> tuple[DataFrame, int]:
        rows = _rows(data)
        width = len(rows.first().x)
        at = [F.get("x", F.lit(j)) for j in range(width)]
        found = rows.agg(*[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
        mean, spread = np.array(found[:width]), np.array(found[width:])
        shape = partial(_scaled, mean=mean, spread=np.where(spread > 0, spread, 1.0))
        return materialize(rows.mapInArrow(partial(_packed, shape=shape, folds=0), BLOCKS)), width

    def fit(self, blocks: DataFrame, width: int, folds: int) -> np.ndarray:
        """Weights of the scaled features and the constant, by fold."""

        def evaluate(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sums = _summed(blocks, partial(_losses, loss=self.loss, points=points)).reshape(folds, points.shape[1], width + 3)
            n = np.maximum(sums[:, :, :1], 1)
            return sums[:, :, 1] / n[:, :, 0], sums[:, :, 2:] / n

        return minimise(evaluate, folds, width + 1, self.rounds, self.tolerance)


# boosted trees


def _renewed(batches: Iterator[pa.RecordBatch], trees: list[list[Tree]], depth: int) -> Iterator[pa.RecordBatch]:
    for x, y, fold, f in _blocks(batches, np.uint8):
        cells = [x, y, fold, np.stack([_advanced(x, f[k], own, depth) for k, own in enumerate(trees)])]
        yield pa.record_batch([pa.array([c.tobytes()], pa.binary()) for c in cells], names=["x", "y", "fold", "f"])


def _sums(batches: Iterator[pa.RecordBatch], trees: list[list[Tree]], depth: int, grown: list[Tree], level: int, first: bool, width: int) -> Iterator[pa.RecordBatch]:
    """Counts and sums of residuals by fold, feature, node of a level and bin."""
    size = 2**level * BINS
    sums = np.zeros((len(grown), 2, width, size))
    for x, y, fold, f in _blocks(batches, np.uint8):
        for k, tree in enumerate(grown):
            at = np.flatnonzero(fold != k)
            xk, yk = x[:, at], y[at].astype(float)
            residual = yk if first else 4 * yk / (1 + np.exp(2 * yk * _advanced(xk, f[k, at], trees[k], depth)))
            base = tree.places(xk, level).astype(np.intp) * BINS
            for j in range(width):
                cell = base + xk[j]
                sums[k, 0, j] += np.bincount(cell, minlength=size)
                sums[k, 1, j] += np.bincount(cell, residual, minlength=size)
    yield _cell(sums)


def _boosted(x: np.ndarray, f: np.ndarray, k: int, trees: list[list[Tree]], depth: int) -> np.ndarray:
    return _advanced(x, f, trees[k], depth)


@dataclass
class FoldBoosting:
    """Boosted trees as those of ``Boosting``; bins come from the rows of all folds, without their classes."""

    iterations: int = 20
    depth: int = 5
    step: float = 0.1

    def accuracies(self, data: DataFrame, folds: int) -> list[float | None]:
        rows = _rows(data)
        width = len(rows.first().x)
        shape = partial(_binned, cuts=cut_points(rows, width))
        blocks = materialize(rows.mapInArrow(partial(_packed, shape=shape, folds=folds), BLOCKS))
        trees: list[list[Tree]] = [[] for _ in range(folds)]
        for m in range(self.iterations):
            if m and not m % RENEW:
                blocks, trees = materialize(blocks.mapInArrow(partial(_renewed, trees=trees, depth=self.depth), BLOCKS)), [[] for _ in range(folds)]
            grown = [Tree([0] * (2**self.depth - 1), [BINS] * (2**self.depth - 1), [0.0] * 2**self.depth) for _ in range(folds)]
            for level in range(self.depth):
                job = partial(_sums, trees=trees, depth=self.depth, grown=grown, level=level, first=not m, width=width)
                for tree, found in zip(grown, _summed(blocks, job).reshape(folds, 2, width, -1)):
                    if found[0].any():
                        _split(tree, level, found, self.step if m else 1.0)
            for own, tree in zip(trees, grown):
                own.append(tree)
        return _accuracies(blocks, np.uint8, folds, partial(_boosted, trees=trees, depth=self.depth))
