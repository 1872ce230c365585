"""Packing token ids into fixed-length sequences: first-fit decreasing in randomised groups.

Each document's ids and an end id are cut into full sequences and a remainder. Pieces are dealt at random into
groups of about ``group`` pieces; in each group pieces go in order of decreasing length into the first sequence
with room, which a tournament tree over the sequences' free room finds in logarithmic time. A task holds one
group, however many documents there are: a piece is dealt by its id, start, crc32 and a number of its own, so rows
that share an id, or are equal, spread over all groups.

Rows: a null or empty text is its end id alone. A very long text is many full sequences. Repeated rows are
packed each on their own; a null doc_id is packed like any other. Ties go by doc_id and start."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import buffers as B
from tradewind.llm.encoding import encoder
from tradewind.llm.grouped import whole_groups
from tradewind.llm.tables import id_back, keyed
from tradewind.sources.stages import materialize

VOCABULARY, END_ID, LENGTH, GROUP = "word_bpe_49k.json", 1, 2048, 5_000
PIECE = "d long, start long, length long, ids_crc32 long, doc_tokens long"


class Tournament:
    """The free room of up to ``n`` bins; each inner node has the greater room of its two children."""

    def __init__(self, n: int, capacity: int):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.room = [capacity] * (2 * self.leaves)

    def put(self, size: int) -> tuple[int, int]:
        """Place ``size`` in the first bin with room for it: the bin, and the room it had."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        before = room[at]
        room[at] = before - size
        found = at - self.leaves
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
        return found, before


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[tuple[int, int]]:
    """Bin and offset for each of ``sizes``, which come in decreasing order and fit in ``capacity``."""
    tree = Tournament(len(sizes), capacity)
    return [(found, capacity - room) for found, room in map(tree.put, sizes)]


def _pieces(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, length: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode, end = encoder(vocabulary, blanks=False).encode, end_id.to_bytes(4, "little")
    for rows, _, _ in B.slices(batches):
        out = []
        for d, ids in zip(rows.column("d").to_pylist(), encode([x or "" for x in rows.column("text").to_pylist()]), strict=True):
            ids += end
            for start in range(0, len(ids), 4 * length):
                piece = ids[start : start + 4 * length]
                out.append((d, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece))
        d, *numbers, pieces = zip(*out, strict=True)
        columns = [pa.array(d, pa.int64()), *(pa.array(x, pa.int64()) for x in numbers)]
        names = ["d", "start", "length", "ids_crc32", "doc_tokens"]
        yield pa.record_batch(columns + [pa.array(pieces, pa.binary())] * with_ids, names=names + ["ids"] * with_ids)


def _pack(batches: Iterator[pa.RecordBatch], length: int, groups: int) -> Iterator[pa.RecordBatch]:
    for table, starts in whole_groups(batches, ["grp"]):
        sizes = table.column("length").to_numpy()
        tie = [table.column(c).to_numpy() for c in ("ids_crc32", "start", "d")]
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            own = slice(first, last)
            order = np.lexsort((*(x[own] for x in tie), -sizes[own]))
            full = int(np.count_nonzero(sizes[own] == length))
            placed = [(i, 0) for i in range(full)]
            placed += [(full + i, at) for i, at in first_fit_decreasing(sizes[own][order[full:]].tolist(), length)]
            found = np.zeros((last - first, 2), np.int64)
            found[order] = placed
            rows = table.slice(first, last - first).drop_columns(["grp"])
            number = found[:, 0] * groups + table.column("grp")[first].as_py()
            rows = rows.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(found[:, 1]))
            yield from rows.combine_chunks().to_batches()


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    end_id: int = END_ID,
    length: int = LENGTH,
    group: int = GROUP,
    with_ids: bool = False,
    seed: int = 0,
) -> DataFrame:
    """A row per piece of every document of ``docs``: [doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset], and with ``with_ids`` the ids (little-endian unsigned 32-bit). A sequence is its pieces by offset,
    padded to ``length``."""
    schema = PIECE + ", ids binary" * with_ids
    pieces = keyed(docs).mapInArrow(partial(_pieces, vocabulary=vocabulary, end_id=end_id, length=length, with_ids=with_ids), schema)
    # Numbered before it is written, so that a piece keeps its number.
    pieces = materialize(pieces.withColumn("piece", F.monotonically_increasing_id()))
    groups = max(1, -(-pieces.count() // group))
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("d", "start", "ids_crc32", "piece", F.lit(seed)), F.lit(groups))).drop("piece")
    dealt = dealt.repartition("grp").sortWithinPartitions("grp")
    packed = dealt.mapInArrow(partial(_pack, length=length, groups=groups), schema + ", sequence_id long, offset long")
    ids = ["ids"] * with_ids
    return packed.select(id_back("d").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *ids)
