"""Packing, sharding, mixing and token files."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tradewind.llm import mixing as M
from tradewind.llm import packing as K
from tradewind.llm import range_coder as C
from tradewind.llm import sharding as S
from tradewind.llm import token_files as T
from tradewind.llm.encoding import Encoder


def whole_ids(name, texts, end):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for x in texts]


@pytest.mark.parametrize("name,blanks", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_words_encode_as_whole_texts(name, blanks):
    draw = random.Random(6)
    pieces = ["a", "don't", "'s", "é", " ", "  ", "\n", "\n\n", "\t", "x1y2", "...", "ÀB", "\x1c", "\x85", " ", "​", "é", "<|endoftext|>", "\x01", "Σ", "🙂"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randrange(30))) for _ in range(400)] + ["w" * 5000]
    got = Encoder(public_tokenizers.path(name), blanks).encode(texts)
    assert [g for g in got] == [w[:-1].tobytes() for w in whole_ids(name, texts, 0)]


def test_first_fit_decreasing():
    draw = random.Random(1)
    for n in (0, 1, 2, 50, 333):
        sizes = sorted((draw.randrange(1, 101) for _ in range(n)), reverse=True)
        assert [b for b, _ in K.first_fit_decreasing(sizes, 100)] == brute.first_fit(sizes, 100)


@pytest.mark.parametrize("group", [K.GROUP, 4])
def test_packing_of_awkward_rows(awkward, group):
    rows = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    packed = K.pack(awkward, group=group, with_ids=True).collect()
    ids = whole_ids(K.VOCABULARY, [t for _, t in rows], 1)
    want = Counter((i, s, min(2048, len(x) - s), zlib.crc32(x[s : s + 2048].tobytes()), len(x)) for (i, _), x in zip(rows, ids, strict=True) for s in range(0, len(x), 2048))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in packed) == want
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in packed)
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048


def test_best_fit_decreasing():
    draw = random.Random(2)
    for n in (0, 1, 10, 400):
        sizes = sorted((float(draw.randrange(1, 200)) for _ in range(n)), reverse=True)
        assert S.best_fit_decreasing(sizes, [1000.0] * 9)[0] == brute.best_fit(sizes, [1000.0] * 9)


def check_shards(docs, shards, divided=()):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    got = S.shard(docs, shards).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in rows)
    assert {r.law for r in got} <= {"bytes"} and all(0 <= r.shard < shards and r.grown_shard is None for r in got)
    slots, homes = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        homes[r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {k for k, v in homes.items() if len(v) > 1} <= set(divided)
    load = [sum(r.size for r in got if r.shard == s) for s in range(shards)]
    return load


def test_sharding_of_awkward_rows(awkward, nothing):
    text = brute.awkward_rows()[5][1].encode()
    check_shards(awkward, 3, [zlib.crc32(text)])
    assert S.shard(nothing).count() == 0


def test_shards_have_equal_bytes(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL", 50)
    monkeypatch.setattr(S, "PER_BUCKET", 30)
    rows = [(i, brute.words_text(i % 300, 5 + i % 40)) for i in range(500)]
    load = check_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8)
    assert max(load) - min(load) < 0.1 * sum(load) / 8


def test_a_group_over_a_shard_is_divided(spark):
    hot = "h" * 100
    rows = [(i, hot) for i in range(200)] + [(1000 + i, brute.words_text(i, 10)) for i in range(200)]
    load = check_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8, [zlib.crc32(hot.encode())])
    assert max(load) - min(load) < 0.1 * sum(load) / 8


def check_capacity(docs, capacity):
    rows = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    got = S.shard_by_capacity(docs, capacity).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in rows)
    held, homes, sizes = defaultdict(list), defaultdict(set), Counter()
    for r in got:
        held[r.shard].append(r)
        homes[r.text_crc32].add(r.shard)
        sizes[r.text_crc32] += r.size
    assert sorted(held) == list(range(len(held)))
    for own in held.values():
        assert sum(r.size for r in own) <= capacity or len(own) == 1
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert all(len(homes[k]) == 1 for k in homes if sizes[k] <= capacity)
    return held, sizes


def test_no_shard_is_over_its_capacity(spark, awkward, nothing, monkeypatch):
    ten = [(i, brute.words_text(i, 400)[:592]) for i in range(10)]
    held, _ = check_capacity(spark.createDataFrame(ten, "doc_id long, text string"), 1000)
    assert len(held) == 10
    hot = [(i, "h" * 92) for i in range(205)] + [(1000 + i, brute.words_text(i, 3 + i % 60)) for i in range(600)]
    docs = spark.createDataFrame(hot, "doc_id long, text string")
    for shards_in_a_cell in (64, 4):
        monkeypatch.setattr(S, "OPEN", shards_in_a_cell)
        held, sizes = check_capacity(docs, 5000)
        assert len(held) <= 1.2 * sum(sizes.values()) / 5000 + 1
    for capacity in (1, 500, 10**9):
        check_capacity(awkward, capacity)
    assert S.shard_by_capacity(nothing, 1000).count() == 0


def test_best_fit_opens_a_shard_where_none_has_room():
    draw = random.Random(3)
    for n in (0, 1, 10, 400):
        sizes = sorted((draw.randrange(1, 1200) for _ in range(n)), reverse=True)
        rooms, want = [], []
        for size in sizes:
            fits = [(room, k) for k, room in enumerate(rooms) if room >= size]
            if not fits:
                rooms.append(1000)
            k = min(fits)[1] if fits else len(rooms) - 1
            rooms[k] -= size
            want.append(k)
        assert S.best_fit_opening(sizes, 1000) == want


def test_mixing_against_brute_force(spark, awkward, monkeypatch):
    monkeypatch.setattr(M, "PER_PREFIX", 20)
    draw = random.Random(9)
    sizes = {"big": 300, "mid": 60, "small": 12, None: 5}
    rows = [(10_000 * k + i, brute.words_text(i, draw.randrange(30)), s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)] + [(5, None, "empty"), (6, " ", "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for options in ({}, {"evenness": 0.999, "repeats": 100.0, "budget": 1.7}):
        got = M.mix(docs, **options).collect()
        weights = {r.source: r.weight for r in got}
        exact = {r.s: r.weight for r in M.block_plan(M.counted_documents(docs), **options).collect()}
        weights = {s: exact["n" if s is None else f"s{s}"] for s in [*sizes, "empty"]}
        counted = [(i, s, len((t or "").split()), t) for i, t, s in rows]
        assert Counter((r.doc_id, r.source, r.block) for r in got) == brute.mixed(counted, weights, options.get("budget", 1.0), M.SEED)
        assert abs(sum(weights.values()) - 1) < 1e-9 and M.mixed_documents(docs, **options).count() == len(got)
        share = Counter()
        for _, s, t, _ in counted:
            share[s] += t
        p = np.array([v for v in share.values() if v]) / sum(share.values())
        w = np.array([weights[s] for s, v in share.items() if v])
        even = -(w * np.log(w)).sum() / np.log(len(w))
        repeats = (w * options.get("budget", 1.0) / p).max()
        assert repeats <= options.get("repeats", M.REPEATS) + 1e-6
        assert even >= options.get("evenness", M.EVENNESS) - 1e-6 or repeats > options.get("repeats", M.REPEATS) - 1e-6
    mixed = M.mixed_documents(awkward)
    assert mixed.columns == awkward.columns and mixed.count() == M.mix(awkward).count()


def test_no_documents(nothing, spark):
    assert K.pack(nothing).count() == M.mix(nothing).count() == M.mixed_documents(nothing).count() == T.round_trip(nothing).count() == 0


def test_range_coder_round_trip():
    rng = np.random.default_rng(3)
    cases = [[], [np.zeros(0, int)], [np.full(3000, 65535), np.array([0]), np.zeros(2000, int)], [rng.integers(0, 65536, rng.integers(0, 200)) for _ in range(40)]]
    for blocks in cases:
        decoded = C.decode_blocks(C.encode_blocks(blocks), [len(b) for b in blocks])
        assert all((a == b).all() for a, b in zip(blocks, decoded, strict=True))


def test_repetitive_ids_are_coded_short_and_damage_is_found():
    ids = np.tile(np.array([5, 900, 70, 42_000]), 4000)
    frame = C.write_frame(ids, 4096)
    assert (C.read_frame(frame) == ids).all() and len(frame) < len(ids) * 4 / 10
    with pytest.raises(ValueError):
        C.read_frame(frame[:-50] + bytes([frame[-50] ^ 255]) + frame[-49:])


def test_ids_are_coded_below_their_order_0_entropy(small_root):
    texts = pq.read_table(f"{small_root}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id").column("text").to_pylist()
    ids = np.concatenate(whole_ids(T.VOCABULARY, [t or "" for t in texts[:600]], 0))[: 1 << 17].astype(np.uint32)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    coded = C.encode_blocks([ids[i : i + T.BLOCK] for i in range(0, len(ids), T.BLOCK)])
    assert 8 * sum(map(len, coded)) < -(share * np.log2(share)).sum() * len(ids)


def test_checksums_of_pieces_join():
    draw = random.Random(4)
    for sizes in ([], [0], [5], [3, 0, 1000, 77], [1, 70_000]):
        parts = [draw.randbytes(n) for n in sizes]
        assert T.joined_crc32([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("options", [{}, {"block": 256, "frame": 4096}])
def test_token_files_of_awkward_rows(awkward, options):
    docs = awkward
    low = -(2**63)
    rows = sorted((low if r.doc_id is None else r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    want, at = Counter(), 0
    for (i, _), ids in zip(rows, whole_ids(T.VOCABULARY, [t for _, t in rows], 0), strict=True):
        want[None if i == low else i, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    assert Counter(tuple(r) for r in T.round_trip(docs, **options).collect()) == want


def test_read_back_ids(spark, tmp_path):
    docs = spark.createDataFrame([(2, "second text"), (1, "first")], "doc_id long, text string")
    T.write_token_files(docs, f"{tmp_path}/files")
    got = T.read_token_files(spark, f"{tmp_path}/files", with_ids=True).orderBy(F.col("start")).collect()
    assert [r.ids for r in got] == [x.tobytes() for x in whole_ids(T.VOCABULARY, ["first", "second text"], 0)]
    T.write_token_files(docs, f"{tmp_path}/cut", block=2, frame=1)
    assert T.read_token_files(spark, f"{tmp_path}/cut", with_ids=True).orderBy("start").collect() == got
