"""Rows without an id, and rows that share one, in the pipeline's deduplication and in packing."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm import brute
from tradewind.llm import mixing as M
from tradewind.llm import packing as K
from tradewind.llm import repeated_spans as R
from tradewind.llm.tables import DOCUMENT

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def near_copy(text: str, at: int) -> str:
    words = text.split()
    words[at] = "changed"
    return " ".join(words)


def test_only_near_copies_are_dropped(spark, small_root):
    own = [brute.words_text(100 + i, 120) for i in range(8)]
    rows = [(None, t) for t in own[:4]] + [(7, own[4]), (7, own[5])]  # unrelated texts without an id, and under one id
    rows += [(None, None), (None, ""), (8, None), (8, " ")]  # no words, no links
    rows += [(20, near_copy(own[0], 60)), (21, near_copy(own[1], 60))]  # near two different rows without an id
    rows += [(31, own[6]), (30, near_copy(own[6], 50)), (None, own[7]), (None, own[7])]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    got = P.near_dedup(spark, docs, small_root)
    want = Counter(rows) - Counter([(20, near_copy(own[0], 60)), (21, near_copy(own[1], 60)), (31, own[6]), (None, own[7])])
    assert got.columns == DOCUMENT and Counter((r.doc_id, r.text) for r in got.collect()) == want


def test_pieces_that_share_an_id_spread_over_groups(spark):
    rows = [(None, brute.words_text(i, 3)) for i in range(400)] + [(None, "")] * 400 + [(5, "the same")] * 400
    packed = K.pack(spark.createDataFrame(rows, "doc_id long, text string"), group=50).collect()
    groups = -(-len(rows) // 50)
    sizes = Counter(r.sequence_id % groups for r in packed)
    assert len(packed) == len(rows) and len(sizes) == groups and max(sizes.values()) < 100


def test_texts_of_one_id_are_told_apart(spark):
    """Two texts with one 32-bit hash under one id, one of them repeated elsewhere: the other keeps all its bytes."""
    texts = spark.range(300_000).selectExpr("concat(md5(cast(id as string)), sha2(cast(id as string), 256), md5(cast(-id as string)), 'abcdefgh') as text")
    alike = texts.selectExpr("text", "hash(text) as h").groupBy("h").agg(F.collect_list("text").alias("texts")).where("size(texts) = 2").first().texts
    for own in (5, None):
        rows = [(-9, alike[0]), (own, alike[0]), (own, alike[1])] if own else [(None, alike[0]), (None, alike[1]), (3, alike[0])]
        found = R.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string"), carry=("doc_id", "text")).collect()
        gone = {(r.doc_id, r.text): r.n_removed for r in found}
        assert gone[own, alike[1]] == 0 and sum(gone.values()) == len(alike[0]) == gone[own if own else 3, alike[0]]


def test_rows_without_an_id_keep_the_budget(spark):
    rows = [(None if i % 3 == 0 else i, brute.words_text(i, i % 17), "ab"[i % 5 == 0]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    given = M.mix(docs, budget=0.5).groupBy("source").agg(F.sum("n_tokens").alias("given"), F.max("target").alias("target")).collect()
    assert len(given) == 2 and all(r.target <= r.given < r.target + 17 for r in given)
    assert M.mixed_documents(docs, budget=0.5).count() == M.mix(docs, budget=0.5).count()
