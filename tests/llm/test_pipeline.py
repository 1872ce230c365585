"""The pipeline's stages, and the registered queries that have SQL."""

from __future__ import annotations

import re
from collections import Counter

import pytest

import corpus_pipeline as P
from tests.check import compare, connection
from tests.llm import brute
from tradewind.llm import mixing, oracle, queries
from tradewind.llm.tables import DOCUMENT


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(spark, small_root, name):
    got = queries.QUERIES[name](spark, small_root).toPandas()
    assert compare(got, connection(small_root).execute(oracle.SQL[name]).df()).startswith("ok")


def test_one_query_for_each_operator():
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES] == list(range(1, 14))
    assert [n for n, _ in P.STAGES] == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "mix_sources", "pack_sequences"]


def test_stages_against_brute_force(spark, small_root):
    docs = spark.read.parquet(f"{small_root}/documents.parquet")
    told = P.language_id(spark, docs, small_root)
    rows = [tuple(r) for r in told.collect()]
    assert told.columns == DOCUMENT and len(rows) == docs.count()  # every given document is in a learned language
    apart = P.near_dedup(spark, told, small_root)
    want = brute.components([r[:2] for r in rows], 5, 80)
    assert sorted(r.doc_id for r in apart.collect()) == sorted(i for i, c in want.items() if i == c)
    cut = P.suffix_array_dedup(spark, apart, small_root)
    left = {r.doc_id: r for r in cut.collect()}
    for i, size, removed, _, digest in brute.repeated([(r.doc_id, r.text) for r in apart.collect()], 100):
        assert len(left[i].text.encode()) <= size - removed and left[i].n_chars == len(left[i].text), digest
    mixed = P.mix_sources(spark, cut, small_root)
    assert mixed.columns == DOCUMENT
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(r.doc_id for r in mixing.mix(cut).collect())
    packed = P.pack_sequences(spark, mixed, small_root)
    assert packed.where("start = 0").count() == mixed.count()


def test_stages_with_awkward_rows(spark, awkward, nothing, small_root):
    for docs in (awkward, nothing):
        for _, stage in P.STAGES[:-1]:
            docs = stage(spark, docs, small_root).cache()
            assert docs.columns == DOCUMENT
        assert P.STAGES[-1][1](spark, docs, small_root).count() >= docs.count()
