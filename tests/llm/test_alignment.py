from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import brute
from tradewind.llm import alignment as A


def expected(texts: list[str | None]) -> list[tuple]:
    """Tokens of whole texts, groups by common ends, and counts over all texts."""
    byte = Tokenizer.from_file(public_tokenizers.path(A.BYTE_VOCABULARY))
    byte.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.PIECE_MODEL))
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = visible + [x for x in range(256) if x not in visible]
    byte_of = {chr(x if x in visible else 256 + i - len(visible)): x for i, x in enumerate(letters)}
    found, counts = [], Counter()
    for t in texts:
        data, a, b = (" " + (t or "")).encode(), [], []
        if t:
            a = [(i, bytes(byte_of[c] for c in byte.id_to_token(i))) for i in byte.encode(" " + t, add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode()) for i in piece.encode(t) for p in [piece.id_to_piece(i)]]
            if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
                a, b = [], []
        ends, groups, links, done = defaultdict(dict), [], [], {0: 0, 1: 0}
        for side, tokens in enumerate((a, b)):
            at = 0
            for k, (_, x) in enumerate(tokens):
                at += len(x)
                ends[at][side] = k
        for at in sorted(ends):
            if len(ends[at]) == 2:
                own = [[i for i, _ in (a, b)[s][done[s] : ends[at][s] + 1]] for s in (0, 1)]
                done = {s: ends[at][s] + 1 for s in (0, 1)}
                groups.append("|".join(",".join(map(str, x)) for x in own))
                links.append((own[0][-1], own[1][-1]))
        counts.update(links)
        found.append((len(a), len(b), groups, links))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (n_a, n_b, len(g), len(x), sum(counts[p] == highest[p[1]] for p in x), sum(counts[p] for p in x), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for n_a, n_b, g, x in found
    ]


ODD = ["don't <s> </s> <0x0A> <|endoftext|>", "a▁b", "tabs\t\there\r\n\r\n  end ", "中文没有空格" * 40, "x" * 3000, "\n", " ", "\x00 nul \x1c\x1d", " no break　wide", "é ẞ ﬁ \U0001f642"]


@pytest.mark.parametrize("options", [{}, {"fragment": 64, "chunk": 50}, {"fragment": 7, "chunk": 1}])
def test_alignment_of_awkward_rows(spark, awkward, options):
    texts = [(r.doc_id, r.text) for r in awkward.collect()] + [(100 + i, t) for i, t in enumerate(ODD)]
    if options.get("fragment") == 7:
        texts = [(i, t and t[:400]) for i, t in texts]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = Counter((i, *e) for (i, _), e in zip(texts, expected([t for _, t in texts]), strict=True))
    assert Counter(tuple(r) for r in A.align(docs, **options).collect()) == want


def test_fragments_compose_in_any_order():
    text = brute.words_text(5, 300) + "\n\n don't  stop" + "中文" * 60 + " end"
    tool = A.aligner(A.BYTE_VOCABULARY, A.PIECE_MODEL)
    whole = tool.documents([text])[0]
    draw = random.Random(1)
    for size in (1, 5, 37, 200, 10_000):
        parts = [tool.fragment(window, start, low, high) for _, low, high, start, window in A.windows(text, size)]
        assert A.finish(A.compose_all(parts)) == whole
        while len(parts) > 1:
            at = draw.randrange(len(parts) - 1)
            parts[at : at + 2] = [A.compose(parts[at], parts[at + 1])]
        assert A.finish(parts[0]) == whole
        assert A.compose(A.EMPTY, parts[0]) == A.compose(parts[0], A.EMPTY) == parts[0]


def test_long_runs_are_read_a_few_times_only():
    assert sum(len(w) for *_, w in A.windows("x" * 10_000, 100)) <= 2 * 10_001
    assert sum(len(w) for *_, w in A.windows("word " * 5_000, 100)) <= 1.2 * 25_001


def test_groups_and_counts_are_given_out(spark):
    docs = spark.createDataFrame([(1, "same text here"), (2, "same text here"), (3, "other")], "doc_id long, text string")
    rows = {r.doc_id: r for r in A.align(docs, with_groups=True).collect()}
    assert rows[1].groups == rows[2].groups and rows[1].groups.count(";") == rows[1].n_groups - 1
    assert hashlib.sha256(rows[3].groups.encode()).hexdigest() == rows[3].groups_sha256
    counts = A.pair_counts(docs).collect()
    assert sum(r["count"] for r in counts) == sum(r.n_links for r in rows.values())
    assert rows[1].count_sum == 2 * rows[1].n_links


def test_nothing_to_align(nothing):
    assert A.align(nothing).collect() == []
