from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewind.llm import word_table as W


def expected(rows: list[tuple]) -> Counter:
    tokenizer, out = Tokenizer.from_file(public_tokenizers.path(W.VOCABULARY)), []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"chunk": 200, "buckets": 3}, {"chunk": 1, "buckets": 1000}])
def test_awkward_rows_round_trip(awkward, options):
    assert Counter(tuple(r) for r in W.round_trip(awkward, **options).collect()) == expected([(r.doc_id, r.text) for r in awkward.collect()])


def test_odd_words_round_trip(spark):
    texts = [" ", "\x85  ", "İstanbul ΣΣ ﬁ é", "\x00", "中文" * 500, "<|startoftext|>\nx", "a\tb\r\nc", "It'S 12 3.5%"]
    rows = [(i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(tuple(r) for r in W.round_trip(docs).collect()) == expected(rows)


def test_ids_and_texts_are_given_out(spark):
    docs = spark.createDataFrame([(1, "Hello there, world"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in W.round_trip(docs, with_texts=True).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(W.VOCABULARY))
    assert rows[1].ids == tokenizer.encode("Hello there, world", add_special_tokens=False).ids
    assert rows[1].decoded == tokenizer.decode(rows[1].ids, skip_special_tokens=False)
    assert rows[2].ids == [] and rows[2].decoded == ""


def test_no_rows(nothing):
    assert W.round_trip(nothing).collect() == []
