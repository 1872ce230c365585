"""Near duplicates and repeated spans against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tests.llm import brute
from tradewind.llm import near_duplicates as N
from tradewind.llm import repeated_spans as R
from tradewind.llm.components import components


def check_groups(docs, words, percent):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = brute.components(rows, words, percent)
    low = -(2**63)
    got = N.near_duplicates(docs, words, percent).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((i, len(brute.shingles(t, words))) for i, t in rows)
    for r in got:
        i = low if r.doc_id is None else r.doc_id
        assert (low if r.component_id is None else r.component_id) == want[i]
        assert r.kept == (i == want[i])


def edited(spark, seed, n, groups):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        text = brute.words_text(100 + i % groups, 60 + 5 * (i % groups)).split()
        for _ in range(draw.choice([0, 0, 1, 2, 3, 8])):
            text[draw.randrange(len(text))] = f"e{draw.randrange(1000)}"
        rows.append((draw.randrange(10**9), " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_groups_of_awkward_rows(awkward, words, percent):
    check_groups(awkward, words, percent)


def test_groups_of_edited_copies_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "LIST_BLOCK", 4)
    monkeypatch.setattr(N, "CLUSTER_BLOCK", 5)
    check_groups(edited(spark, 5, 150, 4), 3, 85)


def test_no_documents(nothing):
    assert N.near_duplicates(nothing).count() == 0
    assert R.remove_repeated(nothing).count() == 0


def test_match_threshold_keeps_pairs_at_the_similarity():
    least = N.match_threshold(85)
    agree = np.random.default_rng(1).binomial(N.COORDINATES, 0.85, 10**6)
    assert (agree < least).mean() < 1e-4 and least > N.COORDINATES // 2


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(1, 41)} == {0} and {got[100 + i] for i in range(1, 30)} == {100}


def check_spans(docs, depth, gram):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = R.remove_repeated(docs, depth, gram).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute.repeated(rows, depth)


@pytest.mark.parametrize("limit", [R.GROUP_LIMIT, 1])
def test_spans_of_awkward_rows(awkward, monkeypatch, limit):
    monkeypatch.setattr(R, "GROUP_LIMIT", limit)
    check_spans(awkward.where("doc_id is null or doc_id not in (4)"), 100, 32)


def test_spans_of_shared_passages(spark):
    draw, passages = random.Random(3), [brute.words_text(900 + i, 12) for i in range(4)]
    rows = [(i, " ".join(draw.choice([*passages, brute.words_text(i * 7 + k, 9)]) for k in range(6))) for i in range(60)]
    check_spans(spark.createDataFrame(rows, "doc_id long, text string"), 20, 8)


def test_a_long_text_is_hashed_in_parts(spark, monkeypatch):
    monkeypatch.setattr(R, "PART", 1000)
    text = brute.words_text(5, 700) + brute.words_text(6, 900) + brute.words_text(5, 650)
    check_spans(spark.createDataFrame([(1, text), (2, text[3000:5000])], "doc_id long, text string"), 100, 32)


def test_kept_text_is_what_is_left(spark):
    text = brute.words_text(8, 60)
    got = {r.doc_id: r.kept_text for r in R.remove_repeated(spark.createDataFrame([(1, text), (2, "new " + text + " end")], "doc_id long, text string")).collect()}
    assert got[1] == text and len(got[2]) < 12 and got[2].startswith("new")
