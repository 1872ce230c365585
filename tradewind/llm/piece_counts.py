"""Greedy word-piece counts by a longest-match automaton, without building pieces.

The vocabulary is a byte trie. Where a node has no edge for the next byte, pieces are popped and matching goes on
at the failure node: a node that is a token pops itself and fails to the root; any other fails to where its parent's
failure leads with its byte, popping what both pop. As every single byte is a token, matching never gets stuck.
Failure chains are folded into one table (state, byte) -> (state, pieces popped), so each byte is one step and the
work is linear in the text. All words of a slice take their steps together.

Rows: a word is a run of bytes other than ASCII white space and is matched with one blank before it. A null or empty
text has no words and no pieces. Repeated rows are counted each; a null doc_id stays null."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import partial

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import buffers as B

VOCABULARY = "byte_bpe_50k.json"
#: With so few words left, stepping one at a time is faster.
FEW = 4
_automata: dict[str, Automaton] = {}


def printable_bytes() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones for themselves, the others
    numbered from 256 in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(name: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary file."""
    path = name if os.path.sep in name else public_tokenizers.path(name)
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {t["content"] for t in content["added_tokens"]}
    to_byte = printable_bytes()
    return [bytes(to_byte[c] for c in piece) for piece in content["model"]["vocab"] if piece not in special]


class Automaton:
    """``table[state * 256 + byte]`` is next state * 256 + pieces popped; ``flush[state]`` the pieces at a word's end."""

    def __init__(self, pieces: list[bytes]):
        edges: list[dict[int, int]] = [{}]
        parent, label, depth, token = [0], [0], [0], [False]
        for piece in {*pieces, *(bytes([b]) for b in range(256))}:
            at = 0
            for b in piece:
                nxt = edges[at].get(b)
                if nxt is None:
                    nxt = edges[at][b] = len(edges)
                    edges.append({})
                    parent.append(at)
                    label.append(b)
                    depth.append(depth[at] + 1)
                    token.append(False)
                at = nxt
            token[at] = True
        n = len(edges)
        parent, label, depth, token = map(np.array, (parent, label, depth, token))
        table = np.zeros((n, 256), np.uint32)
        fail, popped, self.flush = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        by_level = np.argsort(depth, kind="stable")
        bounds = np.searchsorted(depth[by_level], np.arange(depth.max() + 2))
        for level in range(int(depth.max()) + 1):
            own = by_level[bounds[level] : bounds[level + 1]]
            if level:
                moved = table[fail[parent[own]], label[own]].astype(np.int64)
                fail[own] = np.where(token[own], 0, moved >> 8)
                popped[own] = np.where(token[own], 1, popped[parent[own]] + (moved & 255))
                self.flush[own] = popped[own] + self.flush[fail[own]]
                table[own] = table[fail[own]] + popped[own, None].astype(np.uint32)
            kids = [(s, b, t) for s in own.tolist() for b, t in edges[s].items()]
            if kids:
                s, b, t = np.array(kids).T
                table[s, b] = t.astype(np.uint32) << 8
        self.table = table.reshape(-1)
        self.blank = int(self.table[32]) >> 8

    def count(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word [start, end), a blank before it."""
        size = end - start
        order = np.argsort(-size, kind="stable")
        size, begin = size[order], start[order]
        state = np.full(len(order), self.blank, np.int64)
        pieces = np.zeros(len(order), np.int64)
        longest = int(size[0]) if len(size) else 0
        live_at = np.searchsorted(-size, -np.arange(longest), "left")
        for t in range(longest):
            live = int(live_at[t])
            if live <= FEW:
                for i in range(live):
                    at, total = int(state[i]), 0
                    for b in data[begin[i] + t : begin[i] + size[i]].tolist():
                        step = int(self.table[at << 8 | b])
                        at, total = step >> 8, total + (step & 255)
                    state[i] = at
                    pieces[i] += total
                break
            step = self.table[state[:live] << 8 | data[begin[:live] + t]]
            state[:live] = step >> 8
            pieces[:live] += step & 255
        pieces += self.flush[state]
        out = np.empty_like(pieces)
        out[order] = pieces
        return out


def automaton(name: str) -> Automaton:
    """The worker's automaton of a vocabulary file."""
    if name not in _automata:
        _automata[name] = Automaton(vocabulary(name))
    return _automata[name]


def _count(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in B.slices(batches):
        start, end, before = B.word_spans(data, offsets)
        pieces = automaton(name).count(data, start, end)
        most = np.zeros(rows.num_rows, np.int64)
        np.maximum.at(most, B.owners(before), pieces)
        yield pa.record_batch(
            [rows.column("doc_id"), pa.array(np.diff(before)), pa.array(B.span_sums(pieces, before)), pa.array(most)],
            names=["doc_id", "n_words", "n_pieces", "most_pieces"],
        )


def piece_counts(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """[doc_id, n_words, n_pieces, most_pieces] for every row of ``docs``: most_pieces is the largest count of a word."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_count, name=name), "doc_id long, n_words long, n_pieces long, most_pieces long")
