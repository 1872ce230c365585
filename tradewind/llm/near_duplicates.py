"""Near-duplicate documents: MinHash signatures, an inverted join on signature coordinates, exact links.

The match threshold T on H coordinates is the largest with which a pair at the wanted similarity is missed
with a probability under ``MISS``. Two documents that agree in T of H coordinates agree in one of the first
H - T + 1, so only that prefix is posted. Every list of documents under a (coordinate, value) pair is merged
by counting collisions of whole signatures; pairs of too different set sizes and pairs already tied in the
list are skipped. Ties of a list form a forest, so a list of n documents never gives more than n - 1 pairs.
Tied documents form clusters; within a cluster links are confirmed on the full shingle sets, again as a
forest. A list or cluster over a block's size is worked in pairs of blocks, each pair a task of its own.

Rows: documents with equal shingle sets are one node from the start. Null and empty texts, and texts of white
space, have no shingles and no links. Rows that share a doc_id are one node; a null doc_id counts as an id
below all others and comes back as null."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import buffers as B
from tradewind.llm.components import components
from tradewind.llm.grouped import binary_rows, whole_groups
from tradewind.llm.tables import id_back, keyed
from tradewind.sources.stages import materialize

WORDS, PERCENT, COORDINATES, MISS = 5, 80, 64, 1e-6
#: Documents in a block of a list, documents and shingles in a block of a cluster.
LIST_BLOCK, CLUSTER_BLOCK, SHINGLE_BLOCK = 2000, 2000, 2_000_000
_SALTS = np.random.default_rng(77).integers(1, 1 << 63, (2, 1024), dtype=np.uint64) | np.uint64(1)


def match_threshold(percent: int, coordinates: int = COORDINATES, miss: float = MISS) -> int:
    """Largest T with P(fewer than T of the coordinates agree) <= miss at the wanted similarity."""
    p, total, t = percent / 100, 0.0, 0
    while t < coordinates:
        total += math.comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if total > miss:
            break
        t += 1
    return max(t, 1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text with fewer words has one shingle."""
    start, end, before = B.word_spans(B.LOWER[data], offsets)
    hashes = B.mixed(B.span_hashes(B.prefix_hashes(B.LOWER[data]), start, end))
    out = []
    n = len(hashes)
    rolled = np.zeros(max(n - words + 1, 0), np.uint64)
    for k in range(words):
        rolled += hashes[k : k + len(rolled)] * _SALTS[0, k]
    rolled = B.mixed(rolled, words)
    for first, last in zip(before[:-1], before[1:], strict=True):
        m = last - first
        if m >= words:
            out.append(np.unique(rolled[first : last - words + 1]))
        elif m:
            out.append(B.mixed((hashes[first:last] * _SALTS[0, :m]).sum(keepdims=True, dtype=np.uint64), int(m)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


SIGNATURE = "d long, n int, k1 long, k2 long, sig binary, keys array<long>"


def _signatures(batches: Iterator[pa.RecordBatch], words: int, coordinates: int, prefix: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in B.slices(batches):
        sets = shingle_sets(data, offsets, words)
        sizes = np.array([len(s) for s in sets], np.int64)
        full = sizes > 0
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        bounds = np.append(0, np.cumsum(sizes))
        starts = bounds[:-1][full]
        least = np.zeros((coordinates, len(starts)), np.uint64)
        sums = np.zeros((2, len(sets)), np.uint64)
        if len(starts):
            for c in range(coordinates):
                least[c] = np.minimum.reduceat((flat ^ _SALTS[0, c]) * _SALTS[1, c], starts)
            for i in range(2):
                sums[i, full] = np.add.reduceat(B.mixed(flat, i + 3), starts)
        sig = (B.mixed(least, 5) & np.uint64(255)).astype(np.uint8).T
        keys = np.stack([B.mixed(least[c], 1000 + c) for c in range(prefix)], axis=1).view(np.int64)
        lengths = np.where(full, 1, 0)
        yield pa.record_batch(
            [
                rows.column("d"),
                pa.array(sizes.astype(np.int32)),
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer(np.append(0, np.cumsum(lengths * coordinates)).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(sig))]),
                pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths * prefix)).astype(np.int32)), pa.array(keys.reshape(-1))),
            ],
            names=["d", "n", "k1", "k2", "sig", "keys"],
        )


def signatures(texts: DataFrame, words: int, coordinates: int, prefix: int) -> DataFrame:
    """[d, n, k1, k2, sig, keys]: set size, 128-bit key of the set, one byte of each coordinate, posted keys."""
    return texts.mapInArrow(partial(_signatures, words=words, coordinates=coordinates, prefix=prefix), SIGNATURE)


class _Forest:
    """Ties among the rows of one group."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def tie(self, i: int, others: np.ndarray) -> list[int]:
        """One of ``others`` for each tree that is new to ``i``."""
        labels = self.label[others]
        new = labels != self.label[i]
        if not new.any():
            return []
        found, at = np.unique(labels[new], return_index=True)
        self.label[np.isin(self.label, found)] = self.label[i]
        return others[new][at].tolist()


def _cross(sides: np.ndarray | None, i: int, others: np.ndarray) -> np.ndarray:
    """In a pair of different blocks, only rows of the other block."""
    return others if sides is None else others[sides[others] != sides[i]]


def _merge_lists(batches: Iterator[pa.RecordBatch], least: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Forests of pairs with at least ``least`` collisions, list by list; rows of a list by set size."""
    for table, starts in whole_groups(batches, ["key", "i", "j"]):
        d, n = table.column("d").to_numpy(), table.column("n").to_numpy().astype(np.int64)
        i, j, block = (table.column(c).to_numpy() for c in ("i", "j", "block"))
        sig = B.joined_bytes(table.column("sig"))[0].reshape(len(d), -1)
        size = np.diff(starts)
        two = starts[:-1][size == 2]
        two = two[(sig[two] == sig[two + 1]).sum(1) >= least]
        u, v = [d[two]], [d[two + 1]]
        for first, m in zip(starts[:-1][size > 2], size[size > 2], strict=True):
            rows = slice(first, first + m)
            s, k, forest = sig[rows], n[rows], _Forest(m)
            sides = block[rows] if i[first] != j[first] else None
            low = np.searchsorted(k, -(-k * percent // 100))
            for x in range(1, m):
                others = _cross(sides, x, np.arange(low[x], x))
                others = others[(s[others] == s[x]).sum(1) >= least]
                for y in forest.tie(x, others):
                    u.append(d[first + x : first + x + 1])
                    v.append(d[first + y : first + y + 1])
        yield pa.record_batch([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in B.slices(batches):
        sets = shingle_sets(data, offsets, words)
        yield pa.record_batch(
            [*(rows.column(c) for c in ("d", "root", "i", "j", "block")), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.tobytes() for s in sets], pa.binary())],
            names=["d", "root", "i", "j", "block", "n", "hashes"],
        )


def _exact_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Forests of the pairs whose sets reach the similarity, cluster block by cluster block."""
    for table, starts in whole_groups(batches, ["root", "i", "j"]):
        u, v = [], []
        ids, blocks = table.column("d").to_numpy(), table.column("block").to_numpy()
        apart = table.column("i").to_numpy() != table.column("j").to_numpy()
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            m = last - first
            if m < 2:
                continue
            sets = [x.view(np.uint64) for x in binary_rows(table.column("hashes").slice(first, m))]
            size = np.array([len(s) for s in sets])
            order = np.argsort(size, kind="stable")
            sets, size = [sets[x] for x in order], size[order]
            d, sides = ids[first:last][order], blocks[first:last][order] if apart[first] else None
            _, which, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
            holder = np.repeat(np.arange(m), size)[np.argsort(which, kind="stable")]
            begin, seen = np.append(0, np.cumsum(often))[:-1], np.zeros(len(often), np.int64)
            bounds, forest = np.append(0, np.cumsum(size)), _Forest(m)
            low = np.searchsorted(size, -(-size * percent // 100))
            for x in range(m):
                own = which[bounds[x] : bounds[x + 1]]
                both = np.bincount(holder[B.ranges(begin[own], seen[own])], minlength=m) if x else np.zeros(m, np.int64)
                seen[own] += 1
                others = np.arange(low[x], x)
                shared = both[others]
                others = _cross(sides, x, others[100 * shared >= percent * (size[others] + size[x] - shared)])
                forest.tie(x, others)
            _, root = np.unique(forest.label, return_index=True)
            head = dict(zip(forest.label[root].tolist(), root.tolist(), strict=True))
            tied = np.array([head[x] for x in forest.label.tolist()])
            u.append(d[tied != np.arange(m)])
            v.append(d[tied[tied != np.arange(m)]])
        yield pa.record_batch([pa.array(np.concatenate(u) if u else [], pa.int64()), pa.array(np.concatenate(v) if v else [], pa.int64())], names=["u", "v"])


def _block_pairs(df: DataFrame, blocks: str) -> DataFrame:
    """A row for every pair of blocks (i <= j) that the row's own block is in; ``blocks`` is their number."""
    own = F.pmod(F.xxhash64("d"), F.col(blocks)).cast("int")
    return (
        df.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other", blocks)
    )


def candidate_ties(reps: DataFrame, least: int, percent: int) -> DataFrame:
    """[u, v]: forests of the pairs of documents that agree in at least ``least`` coordinates."""
    posted = reps.select("d", F.explode("keys").alias("key"))
    often = posted.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    lists = posted.join(often, "key").withColumn("blocks", F.ceil(F.col("k") / LIST_BLOCK)).drop("k")
    rows = lists.join(reps.select("d", "n", "sig"), "d")
    dealt = _block_pairs(rows, "blocks").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "n", "d")
    return dealt.select("key", "i", "j", "block", "d", "n", "sig").mapInArrow(partial(_merge_lists, least=least, percent=percent), "u long, v long").distinct()


def exact_ties(texts: DataFrame, clusters: DataFrame, sizes: DataFrame, words: int, percent: int) -> DataFrame:
    """[u, v]: forests of the true links inside each cluster [node, root]."""
    placed = clusters.select(F.col("node").alias("d"), "root").union(clusters.select("root", "root").distinct())
    load = placed.join(sizes, "d").groupBy("root").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("docs") / CLUSTER_BLOCK, F.col("shingles") / SHINGLE_BLOCK))
    dealt = _block_pairs(placed.join(load.select("root", blocks.alias("blocks")), "root"), "blocks")
    sets = texts.join(dealt, "d").mapInArrow(partial(_sets, words=words), "d long, root long, i int, j int, block int, n int, hashes binary")
    dealt = sets.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return dealt.mapInArrow(partial(_exact_links, percent=percent), "u long, v long")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, coordinates: int = COORDINATES) -> DataFrame:
    """[doc_id, n_shingles, component_id, kept] for every row of ``docs`` [doc_id, text, ...].

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of ``words``-word shingles
    (A-Z lower-cased); component_id is the smallest doc_id that links reach, and kept marks that document."""
    least = match_threshold(percent, coordinates)
    texts = keyed(docs)
    sigs = materialize(signatures(texts, words, coordinates, coordinates - least + 1))
    own = ["n", "k1", "k2"]
    classes = materialize(sigs.where("n > 0").groupBy(*own).agg(F.min("d").alias("rep")))
    members = materialize(sigs.select("d", *own).join(classes, own, "left").select("d", "n", F.coalesce("rep", "d").alias("rep")))
    reps = sigs.join(classes.select(F.col("rep").alias("d"), *own), ["d", *own], "left_semi").dropDuplicates(["d", *own])
    clusters = components(candidate_ties(reps, least, percent))
    ties = exact_ties(texts, clusters, reps.groupBy("d").agg(F.max("n").alias("n")), words, percent)
    several = members.groupBy("d").agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v <> most")
    same = members.join(several, "d").select(F.col("rep").alias("u"), "v")
    roots = components(ties.union(same))
    return _result(members, roots)


def _result(members: DataFrame, roots: DataFrame) -> DataFrame:
    """One row per document; an id without links is its own component."""
    found = members.join(roots, members.rep == roots.node, "left").withColumn("c", F.coalesce("root", "rep"))
    return found.select(
        id_back("d").alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        id_back("c").alias("component_id"),
        (F.col("d") == F.col("c")).alias("kept"),
    )
