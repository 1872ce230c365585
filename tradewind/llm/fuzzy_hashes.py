"""Document fingerprints: context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk where it is -1 modulo the block size; each chunk gives one of
64 characters. A fingerprint is block size, signature at that size, signature at twice that size. The block size is
the least 3 * 2^k for which 64 chunks cover the text, halved while the signature is shorter than half of that. A
signature has at most 64 characters; the last covers all the rest.

Likeness of two fingerprints is 2 * (common subsequence) / (both lengths), that is 1 - edit distance (insertions and
deletions) / lengths, over signatures of the same block size; 0 without a common run of ``RUN`` characters, or when
the sizes differ by more than a factor of two. Equal fingerprints have likeness 1.

Rows: a null text is empty. A document is followed by the next in order of doc_id and text (nulls first); the last
by the first. Rows that share a doc_id follow each other. One document alone follows itself."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm import buffers as B
from tradewind.llm.tables import by_id, id_back
from tradewind.sources.stages import materialize

LEAST_BLOCK, SIGNATURE, WINDOW, RUN = 3, 64, 7, 4
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def _rolling(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte; bytes before a text count as 0."""
    pad = WINDOW - 1
    place = np.arange(len(data)) + pad * (B.owners(offsets) + 1)
    wide = np.zeros(len(data) + pad * len(offsets), np.uint32)
    wide[place] = data
    out = np.zeros(len(wide), np.uint32)
    shifted = np.zeros(len(wide), np.uint32)
    for k in range(WINDOW):
        past = wide[: len(wide) - k]
        out[k:] += past * np.uint32(1 + WINDOW - k)
        shifted[k:] ^= past << np.uint32(5 * k) if 5 * k < 32 else np.uint32(0)
    return (out + shifted)[place]


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprint of each text."""
    rolled = _rolling(data, offsets).astype(np.int64) + 1
    place = np.flatnonzero(rolled % LEAST_BLOCK == 0)
    third = rolled[place] // LEAST_BLOCK
    level = np.where(third == 0, 40, np.log2(np.maximum(third & -third, 1))).astype(np.int8)
    prefix = B.prefix_hashes(data)
    bounds = np.searchsorted(place, offsets)
    out, cuts, owner, shapes = [], [], [], []
    for i in range(len(offsets) - 1):
        begin, end = int(offsets[i]), int(offsets[i + 1])
        at, high = place[bounds[i] : bounds[i + 1]], level[bounds[i] : bounds[i + 1]]
        k = max(0, int(np.ceil(np.log2(max(end - begin, 1) / (LEAST_BLOCK * SIGNATURE)))))
        while True:
            chosen = at[high >= k]
            if k == 0 or len(chosen) + 1 >= SIGNATURE // 2:
                break
            k -= 1
        shapes.append(k)
        for ends in (chosen, at[high >= k + 1]):
            ends = ends[: SIGNATURE - 1] + 1
            if end > begin and (not len(ends) or ends[-1] < end):
                ends = np.append(ends, end)
            cuts.append(np.append(begin, ends))
            owner.append(len(ends))
    starts = np.concatenate([c[:-1] for c in cuts]) if cuts else np.zeros(0, np.int64)
    ends = np.concatenate([c[1:] for c in cuts]) if cuts else starts
    chars = _LETTERS[(B.mixed(B.span_hashes(prefix, starts.astype(np.int64), ends.astype(np.int64)), 6) >> np.uint64(58)).astype(np.int64)].tobytes().decode()
    edge = np.append(0, np.cumsum(owner)).tolist()
    for i, k in enumerate(shapes):
        out.append(f"{LEAST_BLOCK << k}:{chars[edge[2 * i] : edge[2 * i + 1]]}:{chars[edge[2 * i + 1] : edge[2 * i + 2]]}")
    return out


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit per character of ``a``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for c in b:
        hit = state & masks.get(c, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


def _alike(a: str, b: str) -> float:
    runs = {a[i : i + RUN] for i in range(len(a) - RUN + 1)}
    if not any(b[i : i + RUN] in runs for i in range(len(b) - RUN + 1)):
        return 0.0
    return 2 * common_subsequence(a, b) / (len(a) + len(b))


def likeness(f: str, g: str) -> float:
    """0 to 1."""
    if f == g:
        return 1.0
    (x, a1, a2), (y, b1, b2) = f.split(":"), g.split(":")
    if x == y:
        return max(_alike(a1, b1), _alike(a2, b2))
    if int(x) == 2 * int(y):
        return _alike(a1, b2)
    return _alike(a2, b1) if int(y) == 2 * int(x) else 0.0


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return B.text_bytes(pa.array(texts, pa.large_string()))


ROW = "d long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list[int], texts: list[str], following: list[str], marks: list[str], next_marks: list[str]) -> list[tuple]:
    edited = []
    for text, after in zip(texts, following, strict=True):
        q = len(text) // 4
        edited.append(text[: len(text) - q] + after[:q])
    edited_marks = fingerprints(*_bytes(edited))
    return [
        (d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, likeness(f, g), likeness(f, h))
        for d, t, e, f, g, h in zip(ids, texts, edited, marks, edited_marks, next_marks, strict=True)
    ]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition in order, each compared with the next. The partition's first and last document come with
    their texts (edge 1 and 2): what follows the last stands in another partition."""
    part = TaskContext.get().partitionId()
    names = [c.split()[0] for c in ROW.split(", ")] + ["part", "edge", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.int32(), pa.string()]

    def rows(values: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*values, strict=True), types, strict=True)], names=names)

    held = None
    for batch, data, offsets in B.slices(batches):
        ids, texts, marks = batch.column("d").to_pylist(), batch.column("text").to_pylist(), fingerprints(data, offsets)
        if held is None:
            yield rows([(ids[0], None, None, marks[0], None, None, None, part, 1, texts[0])])
        else:
            ids, texts, marks = [held[0], *ids], [held[1], *texts], [held[2], *marks]
        if len(ids) > 1:
            yield rows([(*r, part, 0, None) for r in _compared(ids[:-1], texts[:-1], texts[1:], marks[:-1], marks[1:])])
        held = ids[-1], texts[-1], marks[-1]
    if held is not None:
        yield rows([(held[0], None, None, held[2], None, None, None, part, 2, held[1])])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for x in range(batch.num_rows):
            row = batch.slice(x, 1)
            values = [row.column(c).to_pylist() for c in ("d", "text", "after", "fingerprint", "after_mark")]
            yield pa.record_batch([pa.array([v]) for v in _compared(*values)[0]], names=[c.split()[0] for c in ROW.split(", ")])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """[doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next] for every row.

    The edited text is the text with its last quarter of characters replaced by the beginning of the next document.
    Texts are shuffled once, by ranges of doc_id; only the two documents at a range's ends meet across ranges, by a join
    of range numbers. Documents with one doc_id (or none) follow each other by text, and the beginnings of their texts
    divide them among ranges."""
    ordered = by_id(docs)
    walked = materialize(ordered.mapInArrow(_walk, ROW + ", part int, edge int, text string"))
    heads = walked.where("edge = 1").select(F.col("part").alias("next"), F.col("text").alias("after"), F.col("fingerprint").alias("after_mark"))
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # numbers of ranges only
    parts = heads.select(F.col("next").alias("part"))
    following = parts.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(along)).alias("next"))
    ends = walked.where("edge = 2").select("d", "part", "text", "fingerprint").join(following, "part").join(heads, "next")
    last = ends.select("d", "text", "after", "fingerprint", "after_mark").mapInArrow(_edges, ROW)
    return walked.where("edge = 0").select(*last.columns).union(last).withColumn("doc_id", id_back("d")).select("doc_id", *last.columns[1:])
