"""Line quality, language, piece counts and fingerprints."""

from __future__ import annotations

import hashlib
import itertools
import random
from collections import Counter

import numpy as np

from tests.llm import brute
from tradewind.llm import fuzzy_hashes as H
from tradewind.llm import languages as L
from tradewind.llm import line_quality as Q
from tradewind.llm import piece_counts as P


def test_base_counts_of_awkward_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    got = Q.judge(awkward, Q.NO_FIELD).collect()
    assert Counter((r.doc_id, *r[1:7]) for r in got) == Counter((i, *brute.base_counts(t)) for i, t in rows)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_decoding_finds_the_best_sequence():
    rng = np.random.default_rng(4)
    field = Q.Field(rng.normal(size=(int(Q._SHIFT[-1]), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    sizes = [0, 1, 5, 7, 3, 0]
    bins = np.stack([Q._SHIFT[k] + rng.integers(0, len(b) + 1, sum(sizes)) for k, b in enumerate(Q.BINS.values())], 1)
    bounds = np.append(0, np.cumsum(sizes))
    labels = field.decode(bins, bounds)
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        score = field.scores(bins[first:last])

        def value(path, score=score):
            steps = sum(field.steps[a, b] for a, b in itertools.pairwise(path))
            return (field.start[path[0]] if path else 0) + steps + sum(score[i, y] for i, y in enumerate(path))

        if last > first:
            assert value(tuple(labels[first:last])) >= max(value(p) for p in itertools.product((0, 1), repeat=last - first)) - 1e-9


def test_quality_agrees_with_labels(spark, small_root):
    docs, labels = (spark.read.parquet(f"{small_root}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.judge(docs, Q.fit(docs, labels)).join(labels, "doc_id").where("not base_failed").toPandas()
    assert (got["kept"] == (got["quality"] == 1)).mean() > 0.95


def test_lines_of_one_page_differ(spark, small_root):
    """Footers and headers of boilerplate planted in good pages are told from their bodies, line by line."""
    docs, labels = (spark.read.parquet(f"{small_root}/{t}.parquet") for t in ("documents", "labels"))
    field = Q.fit(docs, labels)
    good = docs.join(labels.where("quality = 1"), "doc_id").orderBy("doc_id").select("text").toPandas()["text"]
    bodies = ["\n".join([x for x in t.split("\n") if len(x.split()) > 12][:6]) for t in good]
    bodies = [b for b in bodies if b.count("\n") >= 3][:60]
    junk = ["Home | About | Login | Terms | Help", "SHARE!! TWEET!! LIKE!! SUBSCRIBE!! NOW!!", "*** click*** here### for$$$ more%%% &&& ***", "Back | Next | Top | Print | Mail"]
    rows, want = [], {}
    for i, body in enumerate(bodies):
        n, k = body.count("\n") + 1, 2 + i % 3
        foot = "\n".join((junk * 2)[i % 4 : i % 4 + k])
        rows.append((i, body + "\n" + foot if i % 2 else foot + "\n" + body))
        want[i] = "C" * n + "B" * k if i % 2 else "B" * k + "C" * n
    assert len(rows) > 20
    got = {r.doc_id: r.line_labels for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()}
    pairs = [(a, b) for i in want for a, b in zip(want[i], got[i], strict=True)]
    assert sum(a == b for a, b in pairs) > 0.9 * len(pairs)
    for y in "BC":
        assert sum(a == b == y for a, b in pairs) > 0.8 * sum(a == y for a, _ in pairs)
    whole = [r.line_labels for r in Q.judge(docs, field).collect()]
    assert any("C" in x and "B" in x for x in whole)


def test_training_on_awkward_rows(awkward, spark):
    ids = [r.doc_id for r in awkward.select("doc_id").collect() if r.doc_id is not None]
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(sorted(set(ids)))] * 2 + [(None, 1), (10**9, 0)], "doc_id long, quality int")
    field = Q.fit(awkward, labels)
    assert np.isfinite(field.bins).all() and np.isfinite(field.steps).all() and np.isfinite(field.start).all()
    assert Q.judge(awkward, field).count() == awkward.count()


def test_expected_labels_against_all_paths():
    rng = np.random.default_rng(8)
    field = Q.Field(rng.normal(size=(int(Q._SHIFT[-1]), 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    sizes = [1, 4, 3]
    unary, there = rng.normal(size=(3, 4, 2)), np.arange(4) < np.array(sizes)[:, None]
    single, pairs = Q._expected(unary, field, there)
    for i, n in enumerate(sizes):
        paths = list(itertools.product((0, 1), repeat=n))
        weight = np.array([np.exp(field.start[p[0]] + sum(unary[i, t, y] for t, y in enumerate(p)) + sum(field.steps[a, b] for a, b in itertools.pairwise(p))) for p in paths])
        weight /= weight.sum()
        for t in range(n):
            assert np.isclose(single[i, t, 1], sum(w for w, p in zip(weight, paths, strict=True) if p[t]))
        for a, b in itertools.product((0, 1), repeat=2):
            assert np.isclose(pairs[i, a, b], sum(w * sum(s == (a, b) for s in itertools.pairwise(p)) for w, p in zip(weight, paths, strict=True)))


def test_quality_without_labels(awkward, spark):
    assert Q.fit(awkward, spark.createDataFrame([], "doc_id long, quality int")) is Q.NO_FIELD


def test_language_held_out_accuracy(spark, small_root):
    docs = spark.read.parquet(f"{small_root}/documents.parquet")
    got = L.identify(docs).join(docs.select("doc_id", "lang", L.held_out().alias("held_out")), "doc_id").where("held_out").toPandas()
    assert len(got) > 20 and (got["lang"] == got["lang_pred"]).mean() > 0.95


def test_language_counts_against_sets(awkward):
    """The filter's languages of each n-gram are those of plain sets, but for rare false positives."""
    model = L.fit(awkward)
    assert model.languages == ["de", "en"]
    got = L.predict(awkward, model).collect()
    assert len(got) == awkward.count()
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and 0 <= r.known <= 1
    assert model.pass_rates().max() < 0.01


def test_more_languages_than_bits_of_a_word(spark):
    letters = [chr(0x400 + i) for i in range(48)] + [chr(0x3B1 + i) for i in range(24)]
    rows = [(i, (letters[i] * 3 + "q ") * 20, f"l{i:02}", "s") for i in range(72) for _ in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = L.predict(docs, L.fit(docs)).join(docs.distinct(), ["doc_id", "text"]).collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_nothing_learned_and_no_documents(awkward, nothing):
    model = L.fit(nothing)
    assert {(r.lang_pred, r.score) for r in L.predict(awkward, model).collect()} == {("und", 0.0)}
    assert L.identify(nothing).count() == Q.judge(nothing, Q.NO_FIELD).count() == P.piece_counts(nothing).count() == 0


def test_pieces_equal_greedy_matching(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    pieces = set(P.vocabulary(P.VOCABULARY))
    got = P.piece_counts(awkward).collect()
    short = [(i, t) for i, t in rows if len(t or "") < 5000]
    want = Counter((i, len((t or "").encode().split()), brute.greedy_pieces(t, pieces)) for i, t in short)
    assert not want - Counter((r.doc_id, r.n_words, r.n_pieces) for r in got) and len(got) == len(rows)


def test_automaton_on_random_vocabularies():
    draw = random.Random(2)
    for _ in range(20):
        pieces = ["".join(draw.choice("ab") for _ in range(draw.randrange(1, 6))).encode() for _ in range(12)] + [b" a", b" ab"]
        words = ["".join(draw.choice("abc") for _ in range(draw.randrange(1, 30))) for _ in range(40)]
        data = np.frombuffer("".join(words).encode(), np.uint8)
        ends = np.cumsum([len(w) for w in words])
        got = P.Automaton(pieces).count(data, ends - [len(w) for w in words], ends)
        assert got.tolist() == [brute.greedy_pieces(w, set(pieces)) for w in words]


def test_fingerprints_of_awkward_rows(awkward):
    low = -(2**63)
    rows = sorted((low if r.doc_id is None else r.doc_id, r.text or "") for r in awkward.select("doc_id", "text").collect())
    mark = lambda t: H.fingerprints(*H._bytes([t]))[0]
    want = Counter()
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        e = t[: len(t) - len(t) // 4] + after[: len(t) // 4]
        want[None if i == low else i, len(t), hashlib.sha256(e.encode()).hexdigest(), mark(t), mark(e), H.likeness(mark(t), mark(e)), H.likeness(mark(t), mark(after))] += 1
    assert Counter(tuple(r) for r in H.fingerprint_documents(awkward).collect()) == want


def test_rolling_hash_and_subsequences():
    data, draw = b"some bytes that are hashed one by one", random.Random(1)
    rolled = H._rolling(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    for i in range(len(data)):
        window = bytes(7) + data[: i + 1]
        window = window[-7:]
        shifted = 0
        for c in window:
            shifted = (shifted << 5 ^ c) & 0xFFFFFFFF
        assert rolled[i] == (sum(window) + sum((k + 1) * c for k, c in enumerate(window)) + shifted) % 2**32
    for _ in range(100):
        a, b = ("".join(draw.choice("abcd") for _ in range(draw.randrange(70))) for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert H.common_subsequence(a, b) == table[-1][-1]


def test_likeness_of_edits(spark, nothing):
    text = brute.words_text(3, 800)
    close, other = text[:2000] + "!" + text[2000:], brute.words_text(77, 800)
    a, b, c = (H.fingerprints(*H._bytes([t]))[0] for t in (text, close, other))
    assert H.likeness(a, a) == 1 and H.likeness(a, b) > 0.9 and H.likeness(a, c) < 0.2
    assert H.fingerprint_documents(nothing).count() == 0
    alone = H.fingerprint_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert alone.near_next == 1 and alone.near_edited > 0.5
