"""Plain Python versions of the operators, and the table of awkward rows that tests share."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, d long, h int, row string, s string, tokens long, shard int, "
    "size long, slot long, key string, sequence_id long, lang_pred string, score double, n_words long, start long, component_id long"
)


def words_text(seed: int, n: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Null ids, null and empty texts, white space, a very long text, near and exact copies, repeated rows."""
    base = words_text(1, 120)
    near = base.split()
    near[60] = "changed"
    far = base.split()
    far[10::12] = ["x"] * len(far[10::12])
    long = words_text(2, 30_000, 5000)
    texts = [
        (None, "an id that is null, twice"), (None, "another text without an id"), (1, None), (2, ""), (3, " \n\t \r "), (4, long), (5, long[1000:250_000]),
        (6, base), (7, base), (7, base), (8, " ".join(near)), (9, " ".join(far)), (10, "one"), (11, "one"), (12, "Two words"), (13, "two WORDS"),
        (14, "é" * 300 + " ñandú über 🙂 " + "é" * 300), (15, "a" * 500), (16, "line one here\nline one here\n\nline two | # * here\n"), (17, "12345 !!! ???"),
        (18, base + "\n" + words_text(3, 80)), (19, words_text(3, 80).upper()), (20, "\x01 odd \x1c bytes \x85 here  two blanks\n\n"), (20, "the same id, other text"),
        (21, "'s don't we'll <|endoftext|> <|startoftext|>"),
    ]
    sources = ["a", "a", "b", None, "c"]
    langs = ["en", "de", None]
    return [
        (i, t, langs[k % 3], sources[k % 5], 7, None, 1, 2, "r", "s", 3, 4, 5, 6, "k", 7, "x", 0.5, 8, 9, 10) for k, (i, t) in enumerate(texts)
    ]


def shingles(text: str | None, words: int) -> frozenset:
    w = (text or "").encode().lower().split()
    if len(w) >= words:
        return frozenset(zip(*(w[i:] for i in range(words)), strict=False))
    return frozenset([tuple(w)]) if w else frozenset()


def components(rows: list[tuple], words: int, percent: int) -> dict:
    """Smallest id reachable from each id; a null id is below all others."""
    low = -(2**63)
    sets = [(low if i is None else i, shingles(t, words)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def repeated(rows: list[tuple], depth: int) -> Counter:
    """(doc_id, bytes, removed, spans, digest of the rest) of every row."""
    low = -(2**63)
    first: dict[bytes, tuple] = {}
    data = [(low if i is None else i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - depth + 1):
            w = b[s : s + depth]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for s in range(len(b) - depth + 1):
            if first[b[s : s + depth]] < (i, s):
                gone[s : s + depth] = b"\1" * depth
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(b)))
        out.append((None if i == low else i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def base_counts(text: str | None) -> tuple:
    t = text or ""
    w = WORD.findall(t)
    often = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {i + k for i in range(len(w) - 2) if often[tuple(w[i : i + 3])] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), copies, len(covered), failed


def greedy_pieces(text: str | None, pieces: set[bytes]) -> int:
    longest, total = max(map(len, pieces)), 0
    for word in (text or "").encode().split():
        rest = b" " + word
        while rest:
            size = next(k for k in range(min(longest, len(rest)), 0, -1) if rest[:k] in pieces or k == 1)
            rest, total = rest[size:], total + 1
    return total


def first_fit(sizes: list[int], capacity: int) -> list[int]:
    room, out = [], []
    for size in sizes:
        at = next((i for i, r in enumerate(room) if r >= size), len(room))
        if at == len(room):
            room.append(capacity)
        room[at] -= size
        out.append(at)
    return out


def best_fit(sizes: list[float], rooms: list[float]) -> list[int]:
    rooms, out = list(rooms), []
    for size in sizes:
        fits = [(r, i) for i, r in enumerate(rooms) if r >= size]
        _, at = min(fits) if fits else max((r, i) for i, r in enumerate(rooms))
        rooms[at] -= size
        out.append(at)
    return out


def mixed(rows: list[tuple], weights: dict, budget: float, seed: int) -> Counter:
    """(doc_id, source, block) of every document given out; rows are (doc_id, source, tokens, text)."""
    total, out = sum(t for _, _, t, _ in rows), Counter()
    by = defaultdict(list)
    for i, s, t, text in rows:
        by[s].append((i, t, hashlib.md5((text or "").encode()).hexdigest()))
    for s, docs in by.items():
        tokens = sum(t for _, t, _ in docs)
        target = -int(-(weights[s] * total * budget) // 1)
        whole = target // tokens if tokens else 1
        rest = target - whole * tokens
        for block in range(whole + 1):
            keyed = sorted((hashlib.md5(f"{seed}:{block}:{'null' if i is None else i}:{digest}".encode()).hexdigest(), i, t) for i, t, digest in docs)
            used = Counter()
            for key, _, t in keyed:
                used[key] += t
            before, last = 0, None
            for key, i, _ in keyed:
                if key != last:
                    before += used[last] if last else 0
                    last = key
                if block < whole or (rest > 0 and before < rest):
                    out[i, s, block] += 1
    return out
