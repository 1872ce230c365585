"""Line quality: a linear-chain conditional random field marks lines as content or boilerplate.

Each line with a word has a few binned features (share of symbols, capitals, digits, bars, repeated words; length of
words and of the line; its end; an equal line before it). Viterbi decoding finds the best sequence of the
labels content and boilerplate for a document's lines; a document is kept if at least half of its words stand in
content lines and it passes the base rules.

The field is trained on a bounded sample: at most ``sample`` labelled documents of each quality (by a hash of the
id), of each at most ``TRAIN_LINES`` neighbouring lines from a drawn place. Labels of lines are not given. A
document's quality only says that a line agrees with it with a probability of ``AGREE`` before its features are seen;
which lines do is inferred, so a page of one quality can hold lines of the other. Decoding reads every line of every text.

Rows: a null or empty text has no words and fails the base rules. Repeated rows are judged alike; a null doc_id is
judged like any other but not trained on. Without labels of both kinds all lines are content. Very long texts are
read whole, one after another; an empty table gives no rows; other columns are not read, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import buffers as B
from tradewind.llm.tables import drawn_ids
from tradewind.sources.stages import materialize

SAMPLE, TRAIN_LINES, AGREE, LEAST_CONTENT = 1500, 100, 0.8, 0.5
LEAST_WORDS, MOST_REPEATED = 50, 50
#: The counted symbols.
SYMBOLS = b"#*$%&|<>"

_IS = {name: np.isin(np.arange(256), list(chars)) for name, chars in {
    "symbol": SYMBOLS, "bar": b"|", "digit": b"0123456789", "capital": bytes(range(65, 91)), "mark": b"!?;:~^=_+/\\@[]{}()\"'", "stop": b".!?\"'",
}.items()}
_FIRST = (np.arange(256) & 0xC0) != 0x80
#: Feature columns and the bounds between their bins; a bin is one weight per label.
BINS = {
    "symbols": [0.001, 0.02, 0.05, 0.15],
    "bars": [0.001, 0.05],
    "digits": [0.001, 0.05, 0.2],
    "capitals": [0.001, 0.05, 0.15, 0.4],
    "marks": [0.001, 0.02, 0.05],
    "words": [2, 4, 8, 16, 40],
    "letters": [2.5, 4, 6, 9],
    "distinct": [0.2, 0.4, 0.6, 0.8, 0.95],
    "ends": [0.5],
    "copy": [0.5],
}
_SHIFT = np.append(0, np.cumsum([len(b) + 1 for b in BINS.values()]))


def _distinct(groups: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for the first of equal (group, key)."""
    first = np.zeros(len(keys), bool)
    if len(keys):
        mixed = B.mixed(keys ^ B.mixed(groups.astype(np.uint64), 31), 32)
        first[np.unique(mixed, return_index=True)[1]] = True
    return first


@dataclass
class Lines:
    """The worded lines of a slice: bounds per text, number of words, one bin per feature; and the texts' base counts."""

    bounds: np.ndarray
    words: np.ndarray
    bins: np.ndarray
    base: dict[str, np.ndarray]


def read_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    docs = len(offsets) - 1
    start, end, before = B.word_spans(data, offsets)
    prefix = B.prefix_hashes(data)
    word = B.mixed(B.span_hashes(prefix, start, end))
    doc_of_word = B.owners(before)
    # lines: from a text's start or a line feed to the next
    feeds = np.flatnonzero(data == 10)
    text_of_feed = np.searchsorted(offsets, feeds, "right") - 1
    heads = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable") if docs else offsets[:-1]
    text_of_head = np.sort(np.concatenate([np.arange(docs), text_of_feed]), kind="stable")
    tails = np.append(heads[1:], len(data))
    tails[:-1] -= text_of_head[1:] == text_of_head[:-1]
    first_word, past_word = np.searchsorted(start, heads), np.searchsorted(start, tails)
    some = past_word > first_word
    heads, tails, text, first_word, past_word = heads[some], tails[some], text_of_head[some], first_word[some], past_word[some]
    new = _distinct(text, B.span_hashes(prefix, heads, tails) + (tails - heads).astype(np.uint64))

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask, dtype=np.int64))
        return (total[tails] - total[heads]).astype(float)

    n_words = past_word - first_word
    line_of_word = np.repeat(np.arange(len(heads)), n_words)
    fresh = np.bincount(line_of_word, _distinct(line_of_word, word), minlength=len(heads))
    size = np.maximum(per_line(_FIRST[data]), 1)
    last = data[end[past_word - 1] - 1] if len(heads) else np.zeros(0, np.uint8)
    values = [
        *(per_line(_IS[k][data]) / size for k in ("symbol", "bar", "digit", "capital", "mark")),
        n_words, per_line(_FIRST[data] & ~B.SPACE[data]) / np.maximum(n_words, 1), fresh / np.maximum(n_words, 1), _IS["stop"][last], ~new,
    ]
    bins = np.stack([np.searchsorted(b, v, "right") + s for b, v, s in zip(BINS.values(), values, _SHIFT, strict=False)], 1) if len(heads) else np.zeros((0, len(BINS)), int)
    repeated = np.zeros(len(word), bool)
    if len(word) > 2:
        windows = word[:-2] * np.uint64(3) + B.mixed(word[1:-1], 1) * np.uint64(5) + B.mixed(word[2:], 2) * np.uint64(7)
        inside = np.flatnonzero(doc_of_word[:-2] == doc_of_word[2:])
        keys = B.mixed(windows[inside] ^ B.mixed(doc_of_word[inside].astype(np.uint64), 41), 42)
        _, which, often = np.unique(keys, return_inverse=True, return_counts=True)
        twice = inside[often[which] > 1]
        for k in range(3):
            repeated[twice + k] = True
    base = {
        "n_words": np.diff(before),
        "word_chars": B.span_sums(_FIRST[data] & ~B.SPACE[data], offsets),
        "n_symbols": B.span_sums(_IS["symbol"][data], offsets),
        "n_dup_lines": np.bincount(text, ~new, minlength=docs).astype(np.int64),
        "n_repeat_words": B.span_sums(repeated, before),
    }
    return Lines(np.searchsorted(text, np.arange(docs + 1)), n_words, bins, base)


@dataclass
class Field:
    """Weights of the two labels (0 boilerplate, 1 content): per bin, per transition, at the start."""

    bins: np.ndarray
    steps: np.ndarray
    start: np.ndarray

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return self.bins[bins].sum(1)

    def decode(self, bins: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Most likely label of every line (ties: content), all documents a line at a time."""
        score, size = self.scores(bins), np.diff(bounds)
        labels = np.ones(len(bins), np.int8)
        order = np.argsort(-size, kind="stable")
        size, first = size[order], bounds[:-1][order]
        active = int(np.count_nonzero(size))
        if not active:
            return labels
        back = np.zeros((len(bins), 2), np.int8)
        best = np.zeros((active, 2))
        for t in range(int(size[0])):
            live = int(np.searchsorted(-size, -t, "left"))
            at = first[:live] + t
            if t:
                paths = best[:live, :, None] + self.steps
                back[at] = paths[:, 1] >= paths[:, 0]
                best[:live] = np.maximum(paths[:, 0], paths[:, 1]) + score[at]
            else:
                best[:live] = self.start + score[at]
        current = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(int(size[0]) - 1, -1, -1):
            live = int(np.searchsorted(-size, -t, "left"))
            at = first[:live] + t
            labels[at] = current[:live]
            current[:live] = back[at, current[:live]]
        return labels


NO_FIELD = Field(np.tile([0.0, 1.0], (int(_SHIFT[-1]), 1)), np.zeros((2, 2)), np.zeros(2))


def _expected(unary: np.ndarray, field: Field, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: probabilities of each line's labels, and sums over all lines but the last of those of neighbouring pairs."""
    n, longest, _ = unary.shape
    ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    ahead[:, 0] = field.start + unary[:, 0]
    for t in range(1, longest):
        step = np.logaddexp(ahead[:, t - 1, None, 0] + field.steps[0], ahead[:, t - 1, None, 1] + field.steps[1]) + unary[:, t]
        ahead[:, t] = np.where(there[:, t, None], step, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        after = unary[:, t + 1] + behind[:, t + 1]
        step = np.logaddexp(field.steps[:, 0] + after[:, None, 0], field.steps[:, 1] + after[:, None, 1])
        behind[:, t] = np.where(there[:, t + 1, None], step, 0)
    norm = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
    single = np.exp(ahead + behind - norm[:, None, None])
    pairs = np.zeros((n, 2, 2))
    for a in (0, 1):
        for b in (0, 1):
            pair = np.exp(ahead[:, :-1, a] + field.steps[a, b] + unary[:, 1:, b] + behind[:, 1:, b] - norm[:, None])
            pairs[:, a, b] = (pair * there[:, 1:]).sum(1)
    return single, pairs


class _Climb:
    """Gradient steps with a rate for each parameter."""

    def __init__(self, param: np.ndarray, rate: float, ridge: float):
        self.param, self.rate, self.ridge, self.square = param, rate, ridge, 0.0

    def step(self, gradient: np.ndarray) -> None:
        gradient = gradient - self.ridge * self.param
        self.square = 0.9 * self.square + 0.1 * gradient**2
        self.param += self.rate * gradient / (np.sqrt(self.square) + 1e-3)


def train(sequences: list[np.ndarray], labels: list[int], agree: float = AGREE, rounds: int = 150, rate: float = 0.05, ridge: float = 1e-3) -> Field:
    """Likelihood of the documents' labels with the lines' labels latent, piece by piece: first what a line's own
    features say, then with these weights fixed the transitions and the start.

    Each step moves towards the labels expected when the document's label is known (every line leans to it by
    the odds of ``agree``) and away from those expected when it is not."""
    size, sides = np.array([len(s) for s in sequences]), np.array(labels)
    longest, n = int(size.max()), len(sequences)
    bins = np.zeros((n, longest, len(BINS)), np.int64)
    for i, s in enumerate(sequences):
        bins[i, : len(s)] = s
    there = np.arange(longest) < size[:, None]
    weight = np.zeros(n)
    for y in (0, 1):
        weight[sides == y] = 0.5 / max(size[sides == y].sum(), 1)
    lean = np.zeros((n, 1, 2))
    lean[np.arange(n), 0, sides] = np.log(agree / (1 - agree))
    field = Field(np.zeros((int(_SHIFT[-1]), 2)), np.zeros((2, 2)), np.zeros(2))

    lines, side, per_line = bins[there], np.repeat(lean[:, 0], size, 0), np.repeat(weight, size)
    climb = _Climb(field.bins, rate, ridge)
    for _ in range(rounds):
        unary = field.bins[lines].sum(1)
        known, free = (1 / (1 + np.exp(-(u[:, 1] - u[:, 0]))) for u in (unary + side, unary))
        off = np.repeat((known - free) * per_line, len(BINS))
        toward = np.bincount(lines.reshape(-1), off, minlength=len(field.bins))
        climb.step(np.stack([-toward, toward], 1))

    unary = field.bins[bins].sum(2)
    climbs = _Climb(field.steps, rate, ridge), _Climb(field.start, rate, ridge)
    for _ in range(rounds):
        (known, known_pairs), (free, free_pairs) = (_expected(u, field, there) for u in (unary + lean, unary))
        climbs[0].step(((known_pairs - free_pairs) * weight[:, None, None]).sum(0))
        climbs[1].step(((known[:, 0] - free[:, 0]) * weight[:, None]).sum(0))
    return field


def _sampled(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in B.slices(batches):
        lines = read_lines(data, offsets)
        n = np.diff(lines.bounds)
        drawn = B.mixed(rows.column("doc_id").to_numpy().astype(np.int64).view(np.uint64), 51) % np.maximum(n - most + 1, 1).astype(np.uint64)
        first = lines.bounds[:-1] + drawn.astype(np.int64)
        parts = [lines.bins[a : a + k] for a, k in zip(first, np.minimum(n, most), strict=True)]
        yield pa.record_batch([rows.column("doc_id"), rows.column("quality"), pa.array([p.reshape(-1).tolist() for p in parts], pa.list_(pa.int32()))], names=["doc_id", "quality", "bins"])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Train on ``docs`` [doc_id, text] whose ``labels`` [doc_id, quality] are drawn."""
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    drawn = materialize(drawn_ids(known, "quality", sample))
    rows = docs.select("doc_id", "text").where("text is not null").join(drawn, "doc_id")
    read = rows.mapInArrow(partial(_sampled, most=TRAIN_LINES), "doc_id long, quality int, bins array<int>").where("size(bins) > 0")
    table = read.toPandas().sort_values("doc_id")  # bounded by the sample
    if table["quality"].nunique() < 2:
        return NO_FIELD
    return train([np.asarray(b, np.int64).reshape(-1, len(BINS)) for b in table["bins"]], table["quality"].tolist())


RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, content_words long, line_labels string"


def _judge(batches: Iterator[pa.RecordBatch], field: Field, least: float) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in B.slices(batches):
        lines = read_lines(data, offsets)
        content = field.decode(lines.bins, lines.bounds)
        good = B.span_sums(content * lines.words, lines.bounds)
        n = lines.base["n_words"]
        failed = (n < LEAST_WORDS) | (100 * lines.base["n_repeat_words"] > MOST_REPEATED * n)
        kept = ~failed & (good >= least * n)
        marks = np.where(content > 0, "C", "B")
        text = ["".join(marks[a:b]) for a, b in zip(lines.bounds[:-1], lines.bounds[1:], strict=True)]
        columns = [rows.column("doc_id"), *map(pa.array, lines.base.values()), pa.array(failed), pa.array(kept), pa.array(np.diff(lines.bounds)), pa.array(good.astype(np.int64)), pa.array(text, pa.string())]
        yield pa.record_batch(columns, names=[c.split()[0] for c in RESULT.split(", ")])


def judge(docs: DataFrame, field: Field, least: float = LEAST_CONTENT) -> DataFrame:
    """``RESULT`` for every row of ``docs`` [doc_id, text]; line_labels has C or B for each line with a word."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_judge, field=field, least=least), RESULT)
