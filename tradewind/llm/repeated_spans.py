"""Repeated byte strings: a depth-limited most-significant-digit radix sort of suffixes.

Suffixes are ordered through ``depth`` bytes only, and equal groups are the repeated strings. A string's digits
are taken in an order that its own bytes fix: first the ``gram``-byte piece of it with the least hash (leftmost
on ties), then the bytes around that piece. Equal strings have the same pieces in the same places, so this order
groups them as left-to-right digits would; and neighbouring strings share their first digit, so that the strings
of a whole *run* of suffixes (about 35 at the default sizes) go through a pass as one row:

1. first digit: runs whose piece occurs once are sorted out (most of them);
2. second digit: all bytes of the run. Every run but the first of an equal group repeats as a whole;
3. last digit, for first runs whose piece also begins other groups: each suffix alone, from the bytes.

Counting is pre-aggregated. Pieces with many different runs go through pass 3 suffix by suffix, where equal
suffixes are folded before the shuffle; the others are sorted group by group.

Rows: null and empty texts have no strings and are kept empty. A string "starts earlier" at a smaller doc_id, or
in the same doc_id at a smaller byte; rows that share a doc_id are judged by these positions only, so a repeated
row is not removed by its twin. A null doc_id counts as an id below all others. Within one id a text is known by a 64-bit
hash, so rows that share the id and the text are one document. Strings are compared by 64-bit hashes too; these are not
checked against the bytes. A very long text is worked on in one task, of which it fills a slice of its own. An empty
table gives an empty table; columns that are not carried, whatever their names, do not matter. ``GROUP_LIMIT`` only chooses
between two ways to the same result."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm import buffers as B
from tradewind.llm.grouped import whole_groups
from tradewind.llm.tables import id_key
from tradewind.sources.stages import materialize

DEPTH, GRAM = 100, 32
#: Runs under one piece up to which pass 3 sorts them together (about 35 strings each).
GROUP_LIMIT = 50_000
#: Long texts are hashed in parts of so many strings.
PART = 1 << 20
#: The bits that hold a place within a slice of texts.
_PLACE = np.uint64((1 << 22) - 1)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _runs(data: np.ndarray, offsets: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring strings with the same first digit: text, start, strings, place of the piece in the
    first string, hash of the piece, hash of all bytes."""
    n = len(data) - depth + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = B.prefix_hashes(data)
    pieces = (prefix[gram:] - prefix[:-gram]) * B.powers(len(prefix))[1][: len(data) - gram + 1]
    pieces ^= pieces >> np.uint64(29)
    pieces *= np.uint64(0xBF58476D1CE4E5B9)
    # High bits of the hash, then the place: the least of a window tells its piece, leftmost on ties.
    marked = pieces & ~_PLACE
    marked |= np.arange(len(pieces), dtype=np.uint64)
    piece = (_sliding_least(marked, depth - gram + 1) & _PLACE).astype(np.int64)
    change = np.ones(n, bool)
    np.not_equal(piece[1:], piece[:-1], out=change[1:])
    # Strings that run over the end of a text are runs of their own, and left out.
    lasts = np.maximum(offsets[1:] - depth + 1, offsets[:-1])
    for edge in (lasts, offsets[1:]):
        change[edge[edge < n]] = True
    start = np.flatnonzero(change)
    count = np.diff(np.append(start, n))
    text = np.searchsorted(offsets, start, "right") - 1
    keep = start + depth <= offsets[text + 1]
    start, count, text = start[keep], count[keep], text[keep]
    at = piece[start]
    place = at - start
    whole = B.mixed(B.span_hashes(prefix, start, start + count + depth - 1) + (count * 256 + place).astype(np.uint64), 9)
    return text, start - offsets[text], count, place, pieces[at], whole


RUN = "g long, c long, d long, h long, p long"


def _run_rows(batches: Iterator[pa.RecordBatch], depth: int, gram: int) -> Iterator[pa.RecordBatch]:
    """p packs start, strings and place (in this order, so that p sorts by start)."""
    for rows, data, offsets in B.slices(batches):
        ids, marks = rows.column("d").to_numpy(), rows.column("h").to_numpy()
        if rows.num_rows == 1 and len(data) > PART + depth:
            parts = [(x, data[x : x + PART + depth - 1]) for x in range(0, len(data) - depth + 1, PART)]
        else:
            parts = [(0, data)]
        for shift, part in parts:
            bounds = offsets if len(parts) == 1 else np.array([0, len(part)])
            text, start, count, place, piece, whole = _runs(part, bounds, depth, gram)
            packed = (start + shift) << 16 | count << 8 | place
            yield pa.record_batch(
                [pa.array(piece.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(ids[text]), pa.array(marks[text]), pa.array(packed)],
                names=["g", "c", "d", "h", "p"],
            )


def _run_bytes(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed runs of each text."""
    for rows, data, offsets in B.slices(batches):
        lists = rows.column("runs")
        flat, bounds = lists.flatten(), np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy()))
        owner = B.owners(bounds)
        g, p, k = (flat.field(i).to_numpy() for i in range(3))
        begin = offsets[owner] + (p >> 16)
        size = (p >> 8 & 255) + depth - 1
        ids, marks = rows.column("d").to_numpy()[owner], rows.column("h").to_numpy()[owner]
        taken = data[B.ranges(begin, size)]
        places = pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32))
        bytes_ = pa.Array.from_buffers(pa.binary(), len(size), [None, places, pa.py_buffer(taken)])
        yield pa.record_batch([pa.array(g), pa.array(k), pa.array(ids), pa.array(marks), pa.array(p), bytes_], names=["g", "k", "d", "h", "p", "bytes"])


def _suffixes(table: pa.Table, depth: int) -> tuple[np.ndarray, ...]:
    """For every string of every run: row of the run, start in the text, place of the piece, hash."""
    data, offsets = B.joined_bytes(table.column("bytes"))
    p = table.column("p").to_numpy()
    count = p >> 8 & 255
    row = np.repeat(np.arange(len(p)), count)
    step = B.ranges(np.zeros(len(p), np.int64), count)
    begin = offsets[row] + step
    hashes = B.mixed(B.span_hashes(B.prefix_hashes(data), begin, begin + depth), 4)
    return row, (p[row] >> 16) + step, (p[row] & 255) - step, hashes


def _merged(d: np.ndarray, h: np.ndarray, start: np.ndarray, depth: int) -> pa.RecordBatch:
    """Byte spans of strings, neighbours of one text joined; strings come by text and start."""
    if not len(d):
        return pa.record_batch([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.int64())], names=["d", "h", "low", "high"])
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1]) | (start[1:] > start[:-1] + depth) | (start[1:] < start[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(d)) - 1
    return pa.record_batch([pa.array(d[first]), pa.array(h[first]), pa.array(start[first]), pa.array(start[last] + depth)], names=["d", "h", "low", "high"])


def _sorted_groups(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Last digit within whole groups of one piece: spans of the strings that start earlier in another run."""
    for table, starts in whole_groups(batches, ["g"]):
        row, start, place, hashes = _suffixes(table, depth)
        d, h = table.column("d").to_numpy(), table.column("h").to_numpy()
        group = B.owners(starts)[row]
        key = B.mixed(hashes ^ (group.astype(np.uint64) << np.uint64(8)), 2) + place.astype(np.uint64)
        order = np.lexsort((start, d[row], key))
        same = np.zeros(len(order), bool)
        same[1:] = key[order][1:] == key[order][:-1]
        head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        lead = order[head]
        later = (d[row][order] != d[row][lead]) | (start[order] != start[lead])
        repeated = np.zeros(len(order), bool)
        repeated[order] = same & later
        pick = np.flatnonzero(repeated)
        yield _merged(d[row[pick]], h[row[pick]], start[pick], depth)


def _each_suffix(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 2000):
            table = pa.Table.from_batches([batch.slice(first, 2000)])
            row, start, place, hashes = _suffixes(table, depth)
            g, d, h = (table.column(c).to_numpy()[row] for c in ("g", "d", "h"))
            yield pa.record_batch([pa.array(g), pa.array((hashes + place.astype(np.uint64)).view(np.int64)), pa.array(d), pa.array(h), pa.array(start)], names=["g", "w", "d", "h", "start"])


def repeated_spans(texts: DataFrame, depth: int = DEPTH, gram: int = GRAM) -> DataFrame:
    """[d, h, low, high]: byte spans (they may overlap) of texts [d, h, text, row] that repeat an earlier start."""
    runs = texts.select("d", "h", "text").mapInArrow(partial(_run_rows, depth=depth, gram=gram), RUN)
    often = materialize(runs.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("g"))
    runs = materialize(runs.join(often, "g", "left_semi"))
    firsts = materialize(runs.groupBy("g", "c").agg(F.min(F.struct("d", F.shiftright("p", 16).alias("s"), "h", "p")).alias("f")))
    again = runs.join(firsts, ["g", "c"]).where("d <> f.d or shiftright(p, 16) <> f.s")
    whole = again.select("d", "h", F.shiftright("p", 16).alias("low"), F.expr(f"shiftright(p, 16) + (shiftright(p, 8) & 255) + {depth - 1}").alias("high"))
    open_ = firsts.groupBy("g").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    open_ = firsts.join(open_, "g").select("g", "f", "k")
    byte_rows = partial(_run_bytes, depth=depth)

    def held(runs: DataFrame) -> DataFrame:
        """The bytes of these runs. ``texts`` is dealt out by the same keys each time, which Spark does once."""
        listed = runs.groupBy("f.d", "f.h").agg(F.collect_list(F.struct("g", "f.p", "k")).alias("runs"))
        return texts.repartition("d", "h").join(listed, ["d", "h"]).mapInArrow(byte_rows, "g long, k long, d long, h long, p long, bytes binary")

    few = held(open_.where(F.col("k") <= GROUP_LIMIT)).repartition("g").sortWithinPartitions("g")
    spans = few.mapInArrow(partial(_sorted_groups, depth=depth), "d long, h long, low long, high long")
    each = held(open_.where(F.col("k") > GROUP_LIMIT)).mapInArrow(partial(_each_suffix, depth=depth), "g long, w long, d long, h long, start long")
    each = materialize(each)
    earliest = each.groupBy("g", "w").agg(F.min(F.struct("d", "start")).alias("e"))
    later = each.join(earliest, ["g", "w"]).where("d <> e.d or start <> e.start")
    return whole.union(spans).union(later.select("d", "h", F.col("start").alias("low"), (F.col("start") + depth).alias("high")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in B.slices(batches):
        lists = rows.column("spans")
        per_row = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
        flat = lists.flatten()
        begin = np.repeat(offsets[:-1], per_row)
        change = np.zeros(len(data) + 1, np.int64)
        np.add.at(change, begin + flat.field(0).to_numpy(), 1)
        np.add.at(change, begin + flat.field(1).to_numpy(), -1)
        gone = np.cumsum(change[:-1]) > 0
        opens = gone.copy()
        opens[1:] &= ~gone[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        opens[heads] = gone[heads]
        kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.record_batch(
            [
                rows.column("row"),
                pa.array(np.diff(offsets)),
                pa.array(B.span_sums(gone, offsets)),
                pa.array(B.span_sums(opens, offsets)),
                pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()),
            ],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
        )


def remove_repeated(docs: DataFrame, depth: int = DEPTH, gram: int = GRAM, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and [n_bytes, n_removed, n_spans, kept_sha256, kept_text] for every row of ``docs``.

    Every byte covered by a ``depth``-byte string that also starts earlier is removed. kept_text is what
    remains as text; a character that lost some of its bytes is left out of it (not out of the digest)."""
    row = F.struct(*(F.col(c) for c in carry))
    texts = docs.select(id_key().alias("d"), F.coalesce("text", F.lit("")).alias("text"), row.alias("row")).withColumn("h", F.xxhash64("text"))
    spans = repeated_spans(texts, depth, gram).groupBy("d", "h").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    joined = texts.repartition("d", "h").join(spans, ["d", "h"], "left").select("row", "text", "spans")
    schema = T.StructType([texts.schema["row"]]).add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    out = joined.mapInArrow(_cut, schema.add("kept_sha256", "string").add("kept_text", "string"))
    return out.select("row.*", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
