"""Sharding by size: best-fit decreasing over indivisible groups of equal texts.

Law ``bytes``: all shards have nearly the same size. A shard's capacity is its share of all bytes. Groups go in
order of decreasing size into the shard with the tightest room that still holds them, found in a balanced tree of
free rooms; when none holds a group, it goes where most room is left.

Groups with more than 1 / ``HEAVY`` of a shard are placed first, together; there are at most ``HEAVY`` for each
shard, so they fit in the driver. The others are dealt at random into cells of about ``CELL`` groups, and each
cell fills its part of every shard's room on its own, one task per cell. Only a group that is larger than a whole
shard is divided, into as few parts as fit.

Law ``capacity``: shards of a fixed capacity, as few as best-fit decreasing opens; a shard is opened when no open one
has room, so none is over its capacity but one that holds a single row larger than that. Groups of less than
1 / ``HEAVY`` of a shard go together in bundles by hash. Groups and bundles are dealt into cells of about ``OPEN``
shards that are packed on their own; a cell leaves at most its last few shards partly empty.

Rows: a null text counts as empty and stands with the empty texts. Repeated rows are rows of one group, each with
a slot of its own; a null doc_id is placed like any other. Ties go by hash of the text. Texts are read for their sizes and hashes only,
however long; an empty table gives no rows; other columns are not read, whatever their names."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.grouped import whole_groups
from tradewind.llm.tables import id_back, id_key
from tradewind.sources.stages import materialize

SHARDS, HEAVY, CELL, OPEN = 24, 64, 20_000, 64
#: Rows numbered together.
PER_BUCKET = 10_000
GROUP = ["k1", "k2", "size"]
#: What is put into a shard of fixed capacity: a bundle of groups, or (bundle -1) a part of one group.
ITEM = ["bundle", "k1", "k2", "size", "part"]


class RoomTree:
    """Shards by free room in a treap (balanced by random priorities)."""

    class _Node:
        __slots__ = ("key", "left", "rank", "right")

        def __init__(self, key: tuple[float, int], rank: float):
            self.key, self.rank, self.left, self.right = key, rank, None, None

    def __init__(self, rooms: list[float]):
        self._random, self._root = random.Random(5), None
        for shard, room in enumerate(rooms):
            self.add(room, shard)

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a.rank > b.rank:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def _split(self, node, key):
        """Nodes below ``key``, and the others."""
        if node is None:
            return None, None
        if node.key < key:
            node.right, above = self._split(node.right, key)
            return node, above
        below, node.left = self._split(node.left, key)
        return below, node

    def add(self, room: float, shard: int) -> None:
        below, above = self._split(self._root, (room, shard))
        self._root = self._merge(self._merge(below, self._Node((room, shard), self._random.random())), above)

    def remove(self, key: tuple[float, int]) -> None:
        below, rest = self._split(self._root, key)
        _, above = self._split(rest, (key[0], key[1] + 1))
        self._root = self._merge(below, above)

    def tightest(self, size: float) -> tuple[float, int]:
        """The least room of at least ``size``, or the greatest room there is."""
        node, found = self._root, None
        while node is not None:
            if node.key[0] >= size:
                found, node = node.key, node.left
            else:
                node = node.right
        if found is None:
            node = self._root
            while node.right is not None:
                node = node.right
            found = node.key
        return found


def best_fit_decreasing(sizes: list[float], rooms: list[float]) -> tuple[list[int], list[float]]:
    """A shard for each of ``sizes`` (in decreasing order), and the rooms that remain."""
    tree, left, out = RoomTree(rooms), list(rooms), []
    for size in sizes:
        room, shard = tree.tightest(size)
        tree.remove((room, shard))
        left[shard] = room - size
        tree.add(left[shard], shard)
        out.append(shard)
    return out, left


def best_fit_opening(sizes: list[int], capacity: int) -> list[int]:
    """A shard for each of ``sizes`` (in decreasing order); a new one is opened where none has room."""
    tree, shards, out = RoomTree([]), 0, []
    for size in sizes:
        room, shard = tree.tightest(size) if shards else (-1, -1)
        if room >= size:
            tree.remove((room, shard))
        else:
            room, shard, shards = capacity, shards, shards + 1
        tree.add(room - size, shard)
        out.append(shard)
    return out


def numbered(rows: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each ``by`` from 0 without gaps; no task holds more than one hash bucket of them."""
    buckets = max(1, math.ceil(rows.count() / PER_BUCKET))
    held = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = held.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    ranked = held.withColumn("_r", F.row_number().over(inside)).join(offsets, [*by, "_bucket"])
    return ranked.withColumn(name, (F.col("_before") + F.col("_r") - 1).cast("long")).drop("_bucket", "_r", "_before")


def _fill_cells(batches: Iterator[pa.RecordBatch], rooms: list[float]) -> Iterator[pa.RecordBatch]:
    """Best-fit decreasing in each cell, with the cell's part of the rooms."""
    part = np.array(rooms) / max(sum(rooms), 1)
    for table, starts in whole_groups(batches, ["cell"]):
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            own = table.slice(first, last - first).drop_columns(["cell"])
            k1, k2, weight = (own.column(c).to_numpy() for c in ("k1", "k2", "bytes"))
            order = np.lexsort((k2, k1, -weight))
            shards = np.zeros(len(order), np.int32)
            shards[order] = best_fit_decreasing(weight[order].tolist(), (part * weight.sum()).tolist())[0]
            yield from own.drop_columns(["bytes"]).append_column("shard", pa.array(shards)).combine_chunks().to_batches()


def _open_cells(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    """Best-fit decreasing into shards of the cell's own."""
    for table, starts in whole_groups(batches, ["cell"]):
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            own = table.slice(first, last - first)
            *keys, weight = (own.column(c).to_numpy() for c in (*ITEM, "bytes"))
            order = np.lexsort((*keys, -weight))
            inside = np.zeros(len(order), np.int32)
            inside[order] = best_fit_opening(weight[order].tolist(), capacity)
            yield from own.append_column("inside", pa.array(inside)).combine_chunks().to_batches()


def _read(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Size and hashes of every row, and the groups of equal texts."""
    text = F.coalesce("text", F.lit(""))
    rows = materialize(
        docs.select(
            id_key().alias("d"),
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.lit("second"), text, F.octet_length(text)).alias("k2"),
        )
    )
    return rows, materialize(rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")))


def _slotted(placed: DataFrame, law: str) -> DataFrame:
    slotted = numbered(materialize(placed.select("d", "size", "text_crc32", "shard")), ["shard"], ["d", "text_crc32", "size"], "slot")
    return slotted.select(id_back("d").alias("doc_id"), "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def shard_by_capacity(docs: DataFrame, capacity: int) -> DataFrame:
    """As ``shard``, for every row of ``docs`` [doc_id, text], into shards of ``capacity`` bytes (law ``capacity``).

    Only a group larger than a shard is divided, and then by whole rows."""
    rows, groups = _read(docs)
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bundles, cells = max(1, -(-total * 2 * HEAVY // capacity)), max(1, total // (capacity * OPEN))
    per = F.when(F.col("bytes") > capacity, F.greatest(F.lit(1), F.floor(F.lit(capacity) / F.col("size")))).otherwise(F.col("n"))
    bundle = F.when(F.col("bytes") <= capacity / HEAVY, F.pmod(F.xxhash64("k2", "k1"), F.lit(bundles)))
    measured = groups.withColumn("per", per.cast("long")).withColumn("bundle", F.coalesce(bundle, F.lit(-1)).cast("long"))
    filled = measured.where("bundle >= 0").groupBy("bundle").agg(F.sum("bytes").alias("filled"))
    small = filled.where(F.col("filled") <= capacity / 8)  # any other bundle is taken apart
    measured = materialize(measured.join(small.select("bundle", F.lit(True).alias("whole")), "bundle", "left").withColumn("bundle", F.when(F.col("whole"), F.col("bundle")).otherwise(F.lit(-1))).drop("whole"))
    none = F.lit(0).cast("long")
    own = measured.where("bundle < 0").withColumn("part", F.explode(F.sequence(none, F.ceil(F.col("n") / F.col("per")) - 1)))
    items = own.select(*ITEM, (F.least(F.col("per"), F.col("n") - F.col("part") * F.col("per")) * F.col("size")).alias("bytes"))
    together = measured.where("bundle >= 0").groupBy("bundle").agg(F.sum("bytes").alias("bytes"))
    items = items.unionByName(together.select("bundle", *(none.alias(c) for c in ITEM[1:]), "bytes"))
    dealt = items.withColumn("cell", F.pmod(F.xxhash64(*ITEM), F.lit(cells)))
    schema = ", ".join(f"{c} long" for c in (*ITEM, "bytes", "cell")) + ", inside int"
    packed = materialize(dealt.repartition("cell").sortWithinPartitions("cell").mapInArrow(partial(_open_cells, capacity=capacity), schema))
    opened = packed.groupBy("cell").agg((F.max("inside") + 1).alias("opened"))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row per cell
    offsets = opened.select("cell", F.coalesce(F.sum("opened").over(before), F.lit(0)).alias("before"))
    homes = packed.join(offsets, "cell").select(*ITEM, (F.col("before") + F.col("inside")).cast("int").alias("shard"))
    in_bundles = measured.where("bundle >= 0").select(*GROUP, "bundle").join(homes.where("bundle >= 0").select("bundle", "shard"), "bundle")
    alone = measured.where("bundle < 0 and per >= n").select(*GROUP).join(homes.where("bundle < 0"), GROUP)
    out = rows.join(in_bundles.select(*GROUP, "shard").unionByName(alone.select(*GROUP, "shard")), GROUP)
    divided = measured.where("bundle < 0 and per < n").select(*GROUP, "per")
    parts = numbered(rows.join(divided.select(*GROUP), GROUP, "left_semi"), GROUP, ["d"], "number").join(divided, GROUP)
    parts = parts.withColumn("part", F.floor(F.col("number") / F.col("per"))).join(homes.where("bundle < 0").drop("bundle"), [*GROUP, "part"])
    return _slotted(out.unionByName(parts.select(*out.columns)), "capacity")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """[doc_id, size, text_crc32, law, shard, slot, grown_shard] for every row of ``docs`` [doc_id, text] (law ``bytes``)."""
    rows, groups = _read(docs)
    total, many = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    share = total / shards
    heavy = groups.where(F.col("bytes") > share / HEAVY)
    placed = [(*(r[c] for c in GROUP), r["n"], p, parts, r["bytes"] / parts) for r in heavy.collect() for parts in (max(1, math.ceil(r["bytes"] / share)),) for p in range(parts)]
    placed.sort(key=lambda r: (-r[6], *r[:3], r[4]))
    where, rooms = best_fit_decreasing([r[6] for r in placed], [share] * shards)
    rooms = [max(0.0, r) for r in rooms]
    cells = max(1, -(-many // CELL))
    light = groups.where(F.col("bytes") <= share / HEAVY).select(*GROUP, "bytes", F.pmod(F.xxhash64("k2", "k1"), F.lit(cells)).alias("cell"))
    filled = light.repartition("cell").sortWithinPartitions("cell").mapInArrow(partial(_fill_cells, rooms=rooms), "k1 long, k2 long, size long, shard int")
    whole = [(*r[:3], s) for r, s in zip(placed, where, strict=True) if r[5] == 1]
    divided = [(*r[:6], s) for r, s in zip(placed, where, strict=True) if r[5] > 1]
    spark = docs.sparkSession
    assigned = filled.union(spark.createDataFrame(whole, "k1 long, k2 long, size long, shard int")) if whole else filled
    out = rows.join(assigned, GROUP)
    if divided:
        parts = spark.createDataFrame(divided, "k1 long, k2 long, size long, n long, part long, parts long, shard int")
        own = numbered(rows.join(parts.select(*GROUP).distinct(), GROUP, "left_semi"), GROUP, ["d"], "number")
        own = own.join(parts.select(*GROUP, "n", "parts").distinct(), GROUP).withColumn("part", F.floor(F.col("number") * F.col("parts") / F.col("n")))
        out = out.unionByName(own.join(parts.select(*GROUP, "part", "shard"), [*GROUP, "part"]).select(*out.columns))
    return _slotted(out, "bytes")
