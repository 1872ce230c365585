"""Alignment of two tokenizers' ids over the same bytes, and how often each pair of ids ends together in the corpus.

A fragment is what a range of a document's bytes knows of its groups: the tokens up to its first common end (open prefix),
whole groups, and the tokens after its last common end (open suffix); one without a common end is open throughout.
Fragments of neighbouring ranges compose to the fragment of both, and composition is associative, so the fragments of a
long document are made in many tasks and reduced by a tree of group-bys. A token belongs to the range that holds its end; the
task reads a little more text on both sides, up to places where both tokenizers surely break: white space after a visible
character (a blank or a line feed). Ranges without such a place are joined, so that a long run without blanks is
encoded once or twice, and not by each of its ranges. A text up to ``FRAGMENT`` bytes is one fragment, made where it lies.

The counts of pairs come from distinct pairs numbered per chunk of documents: a chunk's pairs with their counts are rows that
Spark sums, and the sums go back to the chunks, whose documents are lists of pair numbers.

Rows: a text that is null, empty or changed by a tokenizer has no tokens. A very long text never is in one task until
its groups are joined at the root of its tree. Repeated rows and rows that share an id or have none are kept each on
their own, and each occurrence counts. Ties: every pair with the highest count of its second id is a best one. An empty table gives an
empty table. Only doc_id and text are read, so other columns, whatever their names, do not matter."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import buffers as B
from tradewind.llm.encoding import SIGNS, encoder
from tradewind.llm.grouped import whole_groups
from tradewind.llm.packed import pack_numbers, unpack_numbers
from tradewind.llm.tables import id_back, keyed
from tradewind.sources.stages import materialize

BYTE_VOCABULARY, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of a range of a long document, fragments that are composed at once, links of a chunk.
FRAGMENT, FAN, CHUNK = 1 << 16, 8, 1_500_000
#: Distinct units a worker keeps (beyond that it starts anew), and how many it learns at once.
CACHE_UNITS, BATCH = 200_000, 10_000
FRAGMENTS = (
    "row long, d long, k long, ok boolean, closed boolean, prefix_a array<int>, prefix_b array<int>, groups binary, links binary, "
    "suffix_a array<int>, suffix_b array<int>, n_a long, n_b long"
)
SPLIT = (
    "chunk long, number int, a int, b int, n long, d array<long>, n_a array<long>, n_b array<long>, n_links array<long>, "
    "groups_sha256 array<string>, groups array<string>, places binary"
)
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_UNSURE = re.compile(r"\s[ \n]|\x01")


def units(text: str) -> list[str]:
    """``text`` cut before each blank or line feed that follows a visible character: no token of either kind spans a cut."""
    if _UNSURE.search(text):
        return _CUT.split(text)
    found = text.replace(" ", "\x01 ").replace("\n", "\x01\n").split("\x01")
    return found if found[0] else found[1:]


class Fragment(NamedTuple):
    """The groups of a range of bytes. ``groups`` are whole ones, written out; ``links`` their last ids, pair after pair.
    Not ``closed``: no common end, and prefix holds all tokens."""

    ok: bool
    closed: bool
    prefix_a: list[int]
    prefix_b: list[int]
    groups: bytes
    links: bytes
    suffix_a: list[int]
    suffix_b: list[int]
    n_a: int
    n_b: int


EMPTY = Fragment(True, False, [], [], b"", b"", [], [], 0, 0)


def _group(a: list[int], b: list[int]) -> tuple[bytes, bytes]:
    return (",".join(map(str, a)) + "|" + ",".join(map(str, b))).encode(), np.array([a[-1], b[-1]], "<u4").tobytes()


def compose_all(parts: list[Fragment]) -> Fragment:
    """The fragment of neighbouring ranges, from left to right."""
    ok, closed, prefix_a, prefix_b, groups, links, open_a, open_b, n_a, n_b = True, False, [], [], [], [], [], [], 0, 0
    for x in parts:
        ok, n_a, n_b = ok and x.ok, n_a + x.n_a, n_b + x.n_b
        open_a, open_b = open_a + x.prefix_a, open_b + x.prefix_b
        if not x.closed:
            continue
        if closed:
            if open_a and open_b:  # else a text that a tokenizer changed
                text, link = _group(open_a, open_b)
                groups.append(text)
                links.append(link)
        else:
            closed, prefix_a, prefix_b = True, open_a, open_b
        if x.groups:
            groups.append(x.groups)
            links.append(x.links)
        open_a, open_b = x.suffix_a, x.suffix_b
    if not closed:
        return Fragment(ok, False, open_a, open_b, b"", b"", [], [], n_a, n_b)
    return Fragment(ok, True, prefix_a, prefix_b, b";".join(groups), b"".join(links), open_a, open_b, n_a, n_b)


def compose(left: Fragment, right: Fragment) -> Fragment:
    return compose_all([left, right])


def finish(whole: Fragment) -> tuple[int, int, bytes, bytes]:
    """Counts of tokens, groups and links of a whole document, whose first byte opens a group and whose last closes one."""
    if not whole.ok or not whole.closed or whole.suffix_a or whole.suffix_b:
        return 0, 0, b"", b""
    text, link = _group(whole.prefix_a, whole.prefix_b)
    return whole.n_a, whole.n_b, text + b";" + whole.groups if whole.groups else text, link + whole.links


class Aligner:
    """Both tokenizers of a worker, and what it knows of the units it has met."""

    def __init__(self, byte_vocabulary: str, piece_model: str):
        self.encoder = encoder(byte_vocabulary, blanks=True, plain=True)
        vocabulary = self.encoder.tokenizer.get_vocab()
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = [x for x in range(256) if x not in visible]
        letter = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(spare)}
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(letter[c] for c in token) if all(c in letter for c in token) else token.encode()
        path = piece_model if "/" in piece_model else public_tokenizers.path(piece_model)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.vocab_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.pieces.is_byte(i) else t.replace("▁", " ").encode() for i, t in enumerate(names)]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.joined = {t[i : i + 2] for t in names for i in range(len(t) - 1)}
        self.written = [b"%d%c" % (i, sign) for i in range(max(len(self.bytes_a), len(names))) for sign in b",|;"]
        self.known: dict[str, tuple[bytes, bytes, int, int]] = {}
        self.bad: set[str] = set()

    def tokens(self, found: list[str]) -> tuple[list[bytes], list[list[int]]]:
        """The ids of both tokenizers for each unit. The second adds a blank before a text: a unit's own first blank
        makes way for it; before anything else stands a line feed, whose two tokens are taken off."""
        a = self.encoder.encode(found)
        self.encoder.known.clear()  # a unit is asked for once
        b = self.pieces.encode([u[1:] if u[0] == " " else "\n" + u for u in found], num_threads=1)
        blank = [self.pieces.piece_to_id("▁")]  # an empty text gets no blank
        return a, [(y or blank) if u[0] == " " else y[2:] for u, y in zip(found, b, strict=True)]

    def flat(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Both tokenizers' ids of all units, one after the other, how many of each a unit has, and which units keep their bytes."""
        a, b = self.tokens(found)
        n_a, n_b = np.fromiter(map(len, a), np.int64, len(a)) // 4, np.fromiter(map(len, b), np.int64, len(b))
        ids_a, ids_b = np.frombuffer(b"".join(a), "<u4").astype(np.int64), np.fromiter(chain.from_iterable(b), np.int64, int(n_b.sum()))
        same = np.ones(len(found), bool)
        whole = "".join(found).encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != whole:
            for k, (u, x, y) in enumerate(zip(found, a, b, strict=True)):
                data = u.encode()
                same[k] = b"".join(self.bytes_a[i] for i in np.frombuffer(x, "<u4")) == data == b"".join(self.bytes_b[i] for i in y)
        return ids_a, n_a, ids_b, n_b, same

    def learn(self, wanted: set[str]) -> None:
        """Letters and the signs after them are learned apart where neither tokenizer joins the two."""
        plain, parts = set(), []
        for unit in wanted:
            stem = unit.rstrip(SIGNS)
            if len(stem) < len(unit) and stem[:1] == " " and stem[1:].isalpha() and stem[-1] + unit[len(stem)] not in self.joined:
                parts.append((unit, stem, unit[len(stem) :]))
                plain.update(parts[-1][1:])
            else:
                plain.add(unit)
        rest = list(plain.difference(self.known))
        for at in range(0, len(rest), BATCH):
            self._learn(rest[at : at + BATCH])
        for unit, stem, sign in parts:
            x, y = self.known[stem], self.known[sign]
            self.known[unit] = x[0] + b";" + y[0], x[1] + y[1], x[2] + y[2], x[3] + y[3]
            if stem in self.bad or sign in self.bad:
                self.bad.add(unit)

    def _learn(self, found: list[str]) -> None:
        ids_a, n_a, ids_b, n_b, same = self.flat(found)
        if not same.all():
            changed = [u for u, good in zip(found, same.tolist(), strict=True) if not good]
            self.bad.update(changed)
            self.known.update(dict.fromkeys(changed, (b"", b"", 0, 0)))
            found = [u for u, good in zip(found, same.tolist(), strict=True) if good]
            if not found:
                return
            ids_a, n_a, ids_b, n_b, _ = self.flat(found)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        last_a, last_b = common[group_a] == ends_a, common[group_b] == ends_b
        codes = np.concatenate([3 * ids_a + last_a, 3 * ids_b + 2 * last_b])[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
        written = list(map(self.written.__getitem__, codes.tolist()))
        text = b"".join(written)
        sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, written), np.int64, len(written)))])
        text_ends = sizes[np.cumsum(n_a + n_b)].tolist()
        links = np.stack([ids_a[last_a], ids_b[last_b]], 1).astype("<u4").tobytes()
        link_ends = (8 * (np.searchsorted(common, ends_a[np.cumsum(n_a) - 1]) + 1)).tolist()
        start = first = 0
        for unit, end, last, x, y in zip(found, text_ends, link_ends, n_a.tolist(), n_b.tolist(), strict=True):
            self.known[unit] = text[start : end - 1], links[first:last], x, y
            start, first = end, last

    def documents(self, texts: list[str]) -> list[tuple[int, int, bytes, bytes]]:
        """Each text as a whole fragment, finished."""
        found = [units(" " + t) if t else [] for t in texts]
        if len(self.known) > CACHE_UNITS:
            self.known.clear()
            self.bad.clear()
        self.learn(set().union(*found).difference(self.known))
        out = []
        for own in found:
            if not own or not self.bad.isdisjoint(own):
                out.append((0, 0, b"", b""))
                continue
            parts = list(map(self.known.__getitem__, own))
            out.append((sum([p[2] for p in parts]), sum([p[3] for p in parts]), b";".join([p[0] for p in parts]), b"".join([p[1] for p in parts])))
        return out

    def fragment(self, window: str, start: int, low: int, high: int) -> Fragment:
        """The fragment of the bytes (low, high] from a window of text that begins at ``start`` and holds them."""
        ids_a, _, ids_b, _, same = self.flat(units(window))
        if not same.all():  # the whole document has no tokens then
            return Fragment(False, False, [], [], b"", b"", [], [], 0, 0)
        a, ends_a = _within(ids_a, start + np.cumsum(self.size_a[ids_a]), low, high)
        b, ends_b = _within(ids_b, start + np.cumsum(self.size_b[ids_b]), low, high)
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not len(common):
            return Fragment(True, False, a.tolist(), b.tolist(), b"", b"", [], [], len(a), len(b))
        cuts_a, cuts_b = (np.searchsorted(common, e, "left") for e in (ends_a, ends_b))  # the group of each token
        split_a, split_b = (np.split(x, np.searchsorted(c, np.arange(1, len(common) + 1))) for x, c in ((a, cuts_a), (b, cuts_b)))
        groups = [_group(x.tolist(), y.tolist()) for x, y in zip(split_a[1:-1], split_b[1:-1], strict=True)]
        return Fragment(
            True, True, split_a[0].tolist(), split_b[0].tolist(), b";".join(g for g, _ in groups), b"".join(x for _, x in groups), split_a[-1].tolist(),
            split_b[-1].tolist(), len(a), len(b),
        )


def _within(ids: np.ndarray, ends: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    own = (ends > low) & (ends <= high)
    return ids[own], ends[own]


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_vocabulary: str, piece_model: str) -> Aligner:
    if (byte_vocabulary, piece_model) not in _aligners:
        _aligners[byte_vocabulary, piece_model] = Aligner(byte_vocabulary, piece_model)
    return _aligners[byte_vocabulary, piece_model]


def windows(text: str, size: int) -> list[tuple[int, int, int, int, str]]:
    """(number, low, high, start, window) of every range of about ``size`` bytes of a blank and ``text``."""
    found = units(" " + text)
    ends = np.cumsum([len(u.encode()) for u in found])
    total, limits = int(ends[-1]), [0]
    for at in range(size, int(ends[-1]), size):
        if np.searchsorted(ends, at, "right") > np.searchsorted(ends, limits[-1], "right"):  # a place to break between the two
            limits.append(at)
    limits.append(total)
    out = []
    for k, (low, high) in enumerate(zip(limits[:-1], limits[1:], strict=True)):
        first, last = int(np.searchsorted(ends, low, "right")), int(np.searchsorted(ends, high, "left")) + 1
        out.append((k, low, high, int(ends[first - 1]) if first else 0, "".join(found[first:last])))
    return out


def _cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in B.slices(batches):
        for row, d, text in zip(*(rows.column(c).to_pylist() for c in ("row", "d", "text")), strict=True):
            found = windows(text, size)
            for first in range(0, len(found), FAN):
                k, low, high, start, window = zip(*found[first : first + FAN], strict=True)
                n = len(k)
                yield pa.record_batch([pa.array([row] * n), pa.array([d] * n), pa.array(k), pa.array(low), pa.array(high), pa.array(start), pa.array(window)], names=["row", "d", "k", "low", "high", "start", "window"])


def _record(keys: list[tuple[int, int, int]], parts: list[Fragment]) -> pa.RecordBatch:
    types = [pa.int64()] * 3 + [pa.bool_()] * 2 + [pa.list_(pa.int32())] * 2 + [pa.binary()] * 2 + [pa.list_(pa.int32())] * 2 + [pa.int64()] * 2
    rows = list(zip(*[(*k, *p) for k, p in zip(keys, parts, strict=True)], strict=True))
    return pa.record_batch([pa.array(x, t) for x, t in zip(rows, types, strict=True)], names=["row", "d", "k", *Fragment._fields])


def _fragments(batches: Iterator[pa.RecordBatch], names: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in B.slices(batches, "window"):
        r = rows.to_pylist()
        yield _record([(x["row"], x["d"], x["k"]) for x in r], [aligner(*names).fragment(x["window"], x["start"], x["low"], x["high"]) for x in r])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One step of the tree: the fragments with one ``row`` and ``parent`` become one."""
    for table, starts in whole_groups(batches, ["row", "parent"]):
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            rows = table.slice(first, last - first).to_pylist()
            own = [Fragment(*(r[f] for f in Fragment._fields)) for r in sorted(rows, key=lambda r: r["k"])]
            yield _record([(rows[0]["row"], rows[0]["d"], rows[0]["parent"])], [compose_all(own)])


def long_documents(texts: DataFrame, size: int, names: tuple[str, str]) -> DataFrame:
    """A whole fragment [row, d, k, ...] for each of the long texts [row, d, text], whose ranges are dealt out over all tasks."""
    cut = texts.mapInArrow(partial(_cut, size=size), "row long, d long, k long, low long, high long, start long, window string")
    parts = materialize(cut.repartition("row", "k").mapInArrow(partial(_fragments, names=names), FRAGMENTS))
    most = (parts.agg(F.max("k")).first()[0] or 0) + 1
    while most > 1:
        grouped = parts.withColumn("parent", F.expr(f"k div {FAN}")).repartition("row", "parent").sortWithinPartitions("row", "parent")
        parts, most = grouped.mapInArrow(_compose, FRAGMENTS), -(-most // FAN)
    return parts


class _Chunks:
    """Documents with their links as numbers of distinct pairs, and these pairs, for every ``limit`` links."""

    def __init__(self, limit: int, with_groups: bool):
        self.limit, self.with_groups, self.held, self.n = limit, with_groups, [], 0
        self.chunk = TaskContext.get().partitionId() << 32

    def add(self, d: int, n_a: int, n_b: int, groups: bytes, links: bytes) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256(groups).hexdigest() if groups else ""
        self.held.append((d, n_a, n_b, len(links) // 8, digest, groups.decode() if self.with_groups else None, links))
        self.n += len(links) // 8 + 1
        if self.n >= self.limit:
            yield from self.rows()

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        *columns, links = zip(*self.held, strict=True)
        pairs = np.frombuffer(b"".join(links), "<u8")  # the first id is the lower half
        distinct, at, n = np.unique(pairs, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        distinct, n = distinct[order], n[order]
        whole = [pa.array([list(x)], t) for x, t in zip(columns, [pa.list_(pa.int64())] * 4 + [pa.list_(pa.string())] * 2, strict=True)]
        nulls = [pa.nulls(1, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]
        names = ["chunk", "number", "a", "b", "n", "d", "n_a", "n_b", "n_links", "groups_sha256", "groups", "places"]
        yield pa.record_batch([pa.array([self.chunk], pa.int64()), *nulls, *whole, pa.array([pack_numbers(rank[at])], pa.binary())], names=names)
        size = len(distinct)
        numbers = [pa.array(np.full(size, self.chunk)), pa.array(np.arange(size, dtype=np.int32))]
        ids = [pa.array((distinct & np.uint64(0xFFFFFFFF)).astype(np.int32)), pa.array((distinct >> np.uint64(32)).astype(np.int32)), pa.array(n, pa.int64())]
        yield pa.record_batch(numbers + ids + [pa.nulls(size, x.type) for x in whole] + [pa.nulls(size, pa.binary())], names=names)
        self.held, self.n, self.chunk = [], 0, self.chunk + 1


def _short(batches: Iterator[pa.RecordBatch], names: tuple[str, str], limit: int, with_groups: bool) -> Iterator[pa.RecordBatch]:
    chunks = _Chunks(limit, with_groups)
    for rows, _, _ in B.slices(batches):
        for d, found in zip(rows.column("d").to_pylist(), aligner(*names).documents(rows.column("text").to_pylist()), strict=True):
            yield from chunks.add(d, *found)
    yield from chunks.rows()


def _chunked(batches: Iterator[pa.RecordBatch], limit: int, with_groups: bool) -> Iterator[pa.RecordBatch]:
    chunks = _Chunks(limit, with_groups)
    for batch in batches:
        for r in batch.to_pylist():
            yield from chunks.add(r["d"], *finish(Fragment(*(r[f] for f in Fragment._fields))))
    yield from chunks.rows()


def _count(batches: Iterator[pa.RecordBatch], with_groups: bool) -> Iterator[pa.RecordBatch]:
    """The documents of each chunk with the counts in the place of the numbers."""
    for table, starts in whole_groups(batches, ["chunk"]):
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            rows = table.slice(first, last - first).combine_chunks()
            own = rows.filter(pc.is_valid(rows.column("places")))
            pairs = rows.filter(pc.is_valid(rows.column("number")))
            number = pairs.column("number").to_numpy()
            count, best = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            count[number], best[number] = pairs.column("count").to_numpy(), pairs.column("best").to_numpy(zero_copy_only=False)
            d, n_a, n_b, n_links, digests, groups = (own.column(c)[0].as_py() for c in ("d", "n_a", "n_b", "n_links", "groups_sha256", "groups"))
            at = unpack_numbers(own.column("places")[0].as_py())
            bounds = np.concatenate([[0], np.cumsum(n_links)]).astype(np.int64)
            out = [pa.array(x, pa.int64()) for x in (d, n_a, n_b, n_links, n_links, B.span_sums(best[at], bounds), B.span_sums(count[at], bounds))]
            names = ["d", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
            out += [pa.array(digests), pa.array(groups, pa.string())][: 1 + with_groups]
            yield pa.record_batch(out, names=names[: len(out)])


def _scored(split: DataFrame) -> DataFrame:
    """[a, b, count, best]: how often each pair of ids ends together; best if no other first id does so oftener with b."""
    counts = split.where("number is not null").groupBy("a", "b").agg(F.sum("n").alias("count"))
    # A window of b has at most as many rows as the first vocabulary has ids.
    highest = F.expr("max(count) over (partition by b)")
    return counts.select("a", "b", "count", (F.col("count") == highest).alias("best"))


def _split(docs: DataFrame, names: tuple[str, str], fragment: int, chunk: int, with_groups: bool) -> DataFrame:
    texts = keyed(docs)
    long = texts.where(F.octet_length("text") > fragment).withColumn("row", F.monotonically_increasing_id())
    short = texts.where(F.octet_length("text") <= fragment).mapInArrow(partial(_short, names=names, limit=chunk, with_groups=with_groups), SPLIT)
    reduced = long_documents(long, fragment, names).mapInArrow(partial(_chunked, limit=chunk, with_groups=with_groups), SPLIT)
    return materialize(short.union(reduced))


def pair_counts(docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL, fragment: int = FRAGMENT, chunk: int = CHUNK) -> DataFrame:
    """[a, b, count, best] of every pair of ids that ends together somewhere in ``docs``."""
    return _scored(_split(docs, (byte_vocabulary, piece_model), fragment, chunk, False))


def align(
    docs: DataFrame, byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL, fragment: int = FRAGMENT, chunk: int = CHUNK, with_groups: bool = False
) -> DataFrame:
    """[doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256] of every document of ``docs``, and with
    ``with_groups`` the groups themselves: ``a1,a2|b1;a3|b2,b3``. Every group has one link, as only its last tokens end together."""
    split = _split(docs, (byte_vocabulary, piece_model), fragment, chunk, with_groups)
    pairs = split.where("number is not null").select("a", "b", "chunk", "number")
    back = pairs.join(_scored(split), ["a", "b"]).select("chunk", "number", "count", "best")
    lists = split.where("number is null").select("chunk", "d", "n_a", "n_b", "n_links", "groups_sha256", "groups", "places")
    both = back.unionByName(lists, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk")
    schema = "d long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + ", groups string" * with_groups
    counted = both.mapInArrow(partial(_count, with_groups=with_groups), schema)
    return counted.select(id_back("d").alias("doc_id"), *counted.columns[1:])
