"""Token ids of documents by a table of distinct words, and texts back from ids by a join with the vocabulary.

1. Each task splits the texts of its rows into words (letters and the signs after them apart) and numbers the distinct
   ones of every ``CHUNK`` bytes of text, the most frequent first. Written once: the documents as lists of these numbers (their words by position), and the words
   themselves in lists by hash bucket.
2. The lists of one bucket meet in one task, so every distinct word of the corpus is encoded once. A frequent word comes
   once from each chunk, however often it stands there. The ids of the distinct words are rows that join the table of
   ids and pieces; a word's pieces in order are its decoded text.
3. Ids and decoded words go back to their chunks and are put in the place of the numbers.

The number of buckets follows the size of the corpus, so that a bucket stays small. Memory: a chunk or a bucket of words in a
task, and the longest single text.

Rows: a null or empty text has no ids, and its decoded text is empty. White space alone likewise. A text with the literal of
a special token, which the tokenizer takes out before all else, is one word of the table. A very long text is a chunk of
its own. Repeated rows and rows that share an id or have none are kept each on their own. An empty table gives an empty
table. Only doc_id and text are read, so other columns, whatever their names, do not matter."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import buffers as B
from tradewind.llm.encoding import SIGNS, encoder
from tradewind.llm.grouped import whole_groups
from tradewind.llm.packed import pack_numbers, pack_texts, unpack_numbers, unpack_texts
from tradewind.llm.tables import id_back, keyed
from tradewind.sources.stages import materialize

VOCABULARY = "word_bpe_49k.json"
#: Bytes of text whose distinct words are numbered together, and bytes of text for each bucket of words.
CHUNK, BUCKET = 32 << 20, 32 << 20
BUCKETS = 64
#: Words of the documents in one list of a chunk, about.
LIST = 100_000
SPLIT = "chunk long, bucket int, words binary, d array<long>, counts array<long>, places binary, buckets binary"
WORDS = "bucket int, word int, at int, id int, chunk long, words binary"
SPELLED = "chunk long, bucket int, spelled binary, d array<long>, counts array<long>, places binary, buckets binary"
RESULT = "d long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class _Numbers(dict):
    """A number for each distinct word, in order of appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _rows(schema: pa.Schema, **columns: list) -> pa.RecordBatch:
    """A batch in which columns that are not given are null."""
    n = len(next(iter(columns.values())))
    return pa.record_batch([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


_LISTS = dict(d=pa.list_(pa.int64()), counts=pa.list_(pa.int64()), places=pa.binary(), buckets=pa.binary())
_SPLIT = _schema(chunk=pa.int64(), bucket=pa.int32(), words=pa.binary(), **_LISTS)
_WORDS = _schema(bucket=pa.int32(), word=pa.int32(), at=pa.int32(), id=pa.int32(), chunk=pa.int64(), words=pa.binary())


def _split(batches: Iterator[pa.RecordBatch], vocabulary: str, buckets: int, limit: int) -> Iterator[pa.RecordBatch]:
    """The chunks of a task: one row with the documents of each, and a row for each bucket of its words."""
    pieces = encoder(vocabulary, blanks=False).pieces
    chunk = TaskContext.get().partitionId() << 32
    numbers, places, d, held = _Numbers(), [], [], 0

    def rows() -> Iterator[pa.RecordBatch]:
        stems, signs = _Numbers(), np.full(len(numbers), -1, np.int32)
        first = np.empty(len(numbers), np.int32)
        for word, k in numbers.items():
            stem = word.rstrip(SIGNS)
            apart = len(stem) < len(word) and stem.isalpha()
            first[k] = stems[stem if apart else word]
            if apart:
                signs[k] = stems[word[len(stem) :]]
        numbers.clear()  # room for the arrays
        sizes = np.array([np.count_nonzero(signs[p] >= 0) + len(p) for p in places], np.int64)
        for k, p in enumerate(places):
            own = np.stack([first[p], signs[p]], 1).ravel()
            places[k] = own[own >= 0]
        ends = np.cumsum(sizes)
        cuts = [0, *(np.flatnonzero(np.diff(ends // LIST)) + 1).tolist(), len(d)]
        parts = [np.concatenate(places[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        places.clear()
        often = np.zeros(len(stems), np.int64)
        for part in parts:
            often += np.bincount(part, minlength=len(stems))
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order))
        words = list(stems)
        words = [words[i].encode() for i in order.tolist()]
        stems.clear()
        where = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        for a, b, part in zip(cuts[:-1], cuts[1:], parts, strict=True):
            yield _rows(_SPLIT, chunk=[chunk], d=[d[a:b]], counts=[sizes[a:b]], places=[pack_numbers(rank[part])])
        yield _rows(_SPLIT, chunk=[chunk], buckets=[pack_numbers(where)])
        by = np.argsort(where, kind="stable")
        found, starts = np.unique(where[by], return_index=True)
        lists = [pack_texts([words[i] for i in part.tolist()]) for part in np.split(by, starts[1:])]
        yield _rows(_SPLIT, chunk=[chunk] * len(found), bucket=found, words=lists)

    for rows_in, data, _ in B.slices(batches):
        for i, text in zip(rows_in.column("d").to_pylist(), rows_in.column("text").to_pylist(), strict=True):
            places.append(np.array(list(map(numbers.__getitem__, pieces(text or ""))), np.int32))
            d.append(i)
        held += len(data)
        if held >= limit:
            yield from rows()
            numbers, places, d, held, chunk = _Numbers(), [], [], 0, chunk + 1
    if d:
        yield from rows()


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: str) -> Iterator[pa.RecordBatch]:
    """For each bucket, the ids of its distinct words, a row for an id, and then the words of each chunk by number."""
    tool = encoder(vocabulary, blanks=False)
    for table, starts in whole_groups(batches, ["bucket"]):
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            bucket, numbers = table.column("bucket")[first].as_py(), _Numbers()
            lists = [np.array(list(map(numbers.__getitem__, unpack_texts(x.as_py()))), np.int64) for x in table.column("words")[first:last]]
            found = tool.encode([w.decode() for w in numbers])
            tool.known.clear()  # a word is asked for once
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            ids = np.frombuffer(b"".join(found), "<u4").astype(np.int32)
            at = B.ranges(np.zeros(len(sizes), np.int64), sizes)
            yield _rows(_WORDS, bucket=np.full(len(ids), bucket), word=np.repeat(np.arange(len(sizes)), sizes), at=at, id=ids)
            chunks = table.column("chunk")[first:last].to_pylist()
            yield _rows(_WORDS, bucket=[bucket] * len(lists), chunk=chunks, words=[pack_numbers(x) for x in lists])


def pieces(spark, vocabulary: str = VOCABULARY) -> DataFrame:
    """[id, piece]: a row for each id of a vocabulary file, special tokens included."""
    known = encoder(vocabulary, blanks=False).tokenizer.get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, t) for t, i in known.items()], "id int, piece string")


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk and bucket, the ids (decimal) and the decoded text of its words."""
    held, bucket, spellings = [], None, []

    def learn() -> None:
        """The words of a bucket from their rows of ids and pieces."""
        spellings.clear()
        if not held:
            return
        rows = pa.Table.from_batches(held)
        word, at = rows.column("word").to_numpy(), rows.column("at").to_numpy()
        first = np.flatnonzero(at == 0)
        if not np.array_equal(at, np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))):
            raise RuntimeError("ids of a word are not together")
        ends = [*first[1:].tolist(), len(at)]
        numbers, texts = list(map(str, rows.column("id").to_pylist())), rows.column("piece").to_pylist()
        spellings.extend([b""] * (int(word[-1]) + 1))
        for w, a, b in zip(word[first].tolist(), first.tolist(), ends, strict=True):
            spellings[w] = (" ".join(numbers[a:b]) + "\t" + " ".join(texts[a:b])).encode()
        held.clear()

    for batch in batches:
        start = 0
        places = np.flatnonzero(batch.column("id").is_null().to_numpy(zero_copy_only=False)).tolist()
        for at in [*places, batch.num_rows]:
            if at > start:
                held.append(batch.slice(start, at - start))
            if at < batch.num_rows:
                own = batch.column("bucket")[at].as_py()
                if own != bucket or held:
                    learn()
                    bucket = own
                words = unpack_numbers(batch.column("words")[at].as_py()).tolist()
                n = len(spellings)  # words at the end may have no ids
                spelled = [spellings[w] if w < n else b"" for w in words]
                yield pa.record_batch([pa.array([batch.column("chunk")[at].as_py()], pa.int64()), pa.array([own], pa.int32()), pa.array([pack_texts(spelled)], pa.binary())], names=["chunk", "bucket", "spelled"])
            start = at + 1


def _join(batches: Iterator[pa.RecordBatch], with_texts: bool) -> Iterator[pa.RecordBatch]:
    """The documents of each chunk with the ids and decoded words in the place of their numbers."""
    for table, starts in whole_groups(batches, ["chunk"]):
        for first, last in zip(starts[:-1], starts[1:], strict=True):
            by_bucket, lists = {}, []
            for r in table.slice(first, last - first).to_batches():
                for bucket, spelled, d, counts, places, buckets in zip(*(r.column(c).to_pylist() for c in ("bucket", "spelled", "d", "counts", "places", "buckets")), strict=True):
                    if spelled is not None:
                        by_bucket[bucket] = spelled
                    elif places is not None:
                        lists.append((d, counts, places))
                    else:
                        where = unpack_numbers(buckets)
            order = np.argsort(where, kind="stable")
            decimal, decoded = [b""] * len(order), [b""] * len(order)
            for part in np.split(order, np.flatnonzero(np.diff(where[order])) + 1):
                for number, spelling in zip(part.tolist(), unpack_texts(by_bucket.pop(int(where[part[0]]))), strict=True):
                    decimal[number], _, decoded[number] = spelling.partition(b"\t")
            tokens = np.array([x.count(b" ") + 1 if x else 0 for x in decimal], np.int64)
            for d, counts, places in lists:
                yield _documents(d, counts, unpack_numbers(places), decimal, decoded, tokens, with_texts)


def _documents(d: list, counts: list, places: np.ndarray, decimal: list, decoded: list, tokens: np.ndarray, with_texts: bool) -> pa.RecordBatch:
    sizes = tokens[places]
    spoken = sizes > 0
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        own = places[a:b][spoken[a:b]].tolist()
        ids, text = b" ".join(map(decimal.__getitem__, own)), b" ".join(map(decoded.__getitem__, own))
        out.append((hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest(), *((ids, text) if with_texts else ())))
    columns = list(zip(*out, strict=True))
    arrays = [pa.array(d, pa.int64()), pa.array(B.span_sums(sizes, bounds)), pa.array(columns[0]), pa.array(columns[1])]
    if with_texts:
        arrays += [pa.array([list(map(int, x.split())) for x in columns[2]], pa.list_(pa.int32())), pa.array([x.decode() for x in columns[3]], pa.string())]
    return pa.record_batch(arrays, names=["d", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"][: len(arrays)])


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, chunk: int = CHUNK, buckets: int | None = None, with_texts: bool = False) -> DataFrame:
    """[doc_id, n_tokens, ids_sha256, decoded_sha256] of every document: its ids in ``vocabulary`` (digest of the decimal
    ids joined by blanks) and the text these decode to; with ``with_texts`` also ids and decoded themselves. ``buckets``
    is the number of lists the distinct words are dealt to, by default one for ``BUCKET`` bytes of text."""
    texts = keyed(docs)
    if buckets is None:
        size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        buckets = max(BUCKETS, size // BUCKET)
    split = materialize(texts.mapInArrow(partial(_split, vocabulary=vocabulary, buckets=buckets, limit=chunk), SPLIT))
    words = split.where("bucket is not null").select("bucket", "chunk", "words").repartition("bucket").sortWithinPartitions("bucket")
    encoded = words.mapInArrow(partial(_encode, vocabulary=vocabulary), WORDS)
    # Broadcast: the vocabulary file bounds it. The rows of a bucket stay together and in order on the way through.
    known = F.broadcast(pieces(docs.sparkSession, vocabulary))
    spelled = encoded.join(known, "id", "left").select("bucket", "word", "at", "id", "piece", "chunk", "words")
    spelled = spelled.mapInArrow(_spell, "chunk long, bucket int, spelled binary")
    lists = split.where("bucket is null").drop("words")
    both = spelled.unionByName(lists, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk")
    joined = both.mapInArrow(partial(_join, with_texts=with_texts), RESULT + ", ids array<int>, decoded string" * with_texts)
    return joined.select(id_back("d").alias("doc_id"), *joined.columns[1:])
