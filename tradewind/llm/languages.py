"""Language identification with bit-sliced Bloom filters of letter n-grams.

One table of slots serves all languages: bit l of a slot belongs to the filter of language l, and the AND of an
n-gram's slots is the set of all languages that contain it. A document's n-grams are counted per language
(population counts of the masks), and each count is corrected for the filter's false positives: of n n-grams
c were found, f is the share of foreign n-grams the filter lets through, so (c - n f) / (1 - f) are expected to
be true. The language with the most is predicted.

Training is bounded: at most ``per_language`` documents of each language (by a hash of the id) are read, and a
language holds an n-gram if its share of that language's n-grams is at least ``RARE`` of the highest share in any
language, so that stray foreign lines do not count. Prediction reads every whole text.

Rows: a null or letterless text, and every text when nothing was learned, is ``und`` with score 0. Ties go to the
language that sorts first. Repeated rows are predicted alike. A null doc_id is not held out and not learned from."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm import buffers as B
from tradewind.llm.tables import drawn_ids
from tradewind.sources.stages import materialize

GRAM, SLOTS, PROBES, PER_LANGUAGE, RARE = 4, 1 << 20, 3, 2000, 0.2
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is no letter."""
    if not _letters:
        table = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                table[i] = ord(c.lower()[0])
        _letters.append(table)
    return _letters[0]


def letter_grams(texts: list[str], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams inside words (with one border on each side), their bounds per text, and whether
    each text has a letter."""
    lengths = np.array([len(t) for t in texts], np.int64) + 2
    joined = np.frombuffer(("\0" + "\0\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    code = letter_table()[np.minimum(joined, 0x10FFFF)]
    bounds = np.append(0, np.cumsum(lengths))
    has = B.span_sums(code > 0, bounds) > 0
    n = max(len(code) - gram + 1, 0)
    hashes = np.zeros(n, np.uint64)
    inner = np.ones(n, bool)
    for k in range(gram):
        part = code[k : k + n]
        hashes = hashes * np.uint64(0x100000001B3) + part
        if 0 < k < gram - 1:
            inner &= part > 0
    inner &= (code[:n] > 0) | (code[gram - 1 : gram - 1 + n] > 0)
    place = np.flatnonzero(inner)
    return B.mixed(hashes[place], 21), np.searchsorted(place, bounds), has


def _text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for rows, _, _ in B.slices(batches, limit=B.SLICE_BYTES // 2):
        yield rows, [x or "" for x in rows.column("text").to_pylist()]


def _learn(batches: Iterator[pa.RecordBatch], gram: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in _text_slices(batches):
        hashes, bounds, _ = letter_grams(texts, gram)
        lang = np.array(rows.column("lang").to_pylist(), object)[B.owners(bounds)]
        table = pa.table({"g": hashes.view(np.int64), "lang": pa.array(lang, pa.string())})
        counts = table.group_by(["g", "lang"]).aggregate([([], "count_all")])
        yield from counts.rename_columns(["g", "lang", "k"]).to_batches()


@dataclass
class Model:
    """Languages in order, and the slots: one word of bits for each 64 languages."""

    languages: list[str]
    slots: np.ndarray
    gram: int
    probes: int

    def addresses(self, hashes: np.ndarray) -> list[np.ndarray]:
        high, low = hashes >> np.uint64(32), hashes & np.uint64(0xFFFFFFFF)
        return [((low + np.uint64(i) * (high | np.uint64(1))) % np.uint64(self.slots.shape[1])).astype(np.int64) for i in range(self.probes)]

    def pass_rates(self) -> np.ndarray:
        """For each language the share of foreign n-grams its filter lets through."""
        return np.array([(self.slots[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() ** self.probes for i in range(len(self.languages))])


def fit(docs: DataFrame, gram: int = GRAM, slots: int = SLOTS, probes: int = PROBES, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from ``docs`` [doc_id, text, lang]; rows without a language are not used."""
    known = docs.select("doc_id", "lang").where("doc_id is not null and lang is not null")
    chosen = materialize(drawn_ids(known, "lang", per_language).select("doc_id").distinct())
    sample = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null").join(chosen, "doc_id", "left_semi")
    counts = sample.select("text", "lang").mapInArrow(partial(_learn, gram=gram), "g long, lang string, k long").groupBy("g", "lang").agg(F.sum("k").alias("k"))
    counts = counts.toPandas()  # bounded by the sample
    languages = sorted(counts["lang"].unique())
    model = Model(languages, np.zeros((len(languages) // 64 + 1, slots), np.uint64), gram, probes)
    if languages:
        share = counts["k"] / counts.groupby("lang")["k"].transform("sum")
        counts = counts[share >= RARE * share.groupby(counts["g"]).transform("max")]
        for i, name in enumerate(languages):
            for at in model.addresses(counts.loc[counts["lang"] == name, "g"].to_numpy().astype(np.int64).view(np.uint64)):
                model.slots[i // 64, at] |= np.uint64(1 << (i % 64))
    return model


def _predict(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    names = np.array([*model.languages, "und"], object)
    rates = model.pass_rates()
    for rows, texts in _text_slices(batches):
        hashes, bounds, has = letter_grams(texts, model.gram)
        n = np.diff(bounds)
        found = np.zeros((len(names), len(texts)))
        at = model.addresses(hashes)
        for word in range(len(model.slots)):
            mask = model.slots[word][at[0]] if at else np.zeros(0, np.uint64)
            for other in at[1:]:
                mask &= model.slots[word][other]
            for i in range(64 * word, min(64 * word + 64, len(model.languages))):
                c = B.span_sums((mask >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64), bounds)
                found[i] = np.clip((c - n * rates[i]) / max(1 - rates[i], 1e-9), 0, None)
        total = found.sum(0)
        best = np.where(has & (len(names) > 1), found[:-1].argmax(0) if len(names) > 1 else 0, len(names) - 1)
        most = found[best, np.arange(len(texts))]
        score = np.where(total > 0, most / np.maximum(total, 1e-12), 0.0)
        known = np.clip(most / np.maximum(n, 1), 0, 1)
        yield pa.record_batch(
            [*(rows.column(c) for c in rows.schema.names), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(known)],
            names=[*rows.schema.names, "lang_pred", "score", "known"],
        )


def predict(docs: DataFrame, model: Model, columns: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``columns`` of ``docs`` (text among them) and [lang_pred, score, known]: score is the language's part of all
    languages' true n-grams, known the part of the document's n-grams that it holds."""
    rows = docs.select(*columns)
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("known", T.DoubleType())])
    return rows.mapInArrow(partial(_predict, model=model), schema)


def held_out() -> Column:
    """True for the documents that are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "text"), **options) -> DataFrame:
    """``predict`` for every row of ``docs``, learned from its rows that are not held out."""
    return predict(docs, fit(docs.where(~held_out()), **options), columns)
