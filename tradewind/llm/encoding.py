"""Token ids of whole texts with a public tokenizer, each distinct word encoded once per cache."""

from __future__ import annotations

import os
import re
from collections.abc import Iterable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: Words a worker keeps; beyond that it starts anew, which costs time and changes nothing else.
CACHE_WORDS = 500_000
#: Words that are encoded as one text, and cut apart again by their marked ends.
JOINED = 200
_EDGES = re.compile(r"\s\s|\A\s|\s\Z|\x01")
#: ASCII signs other than the apostrophe: after letters they are a pre-token of their own.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_encoders: dict[tuple[str, bool, bool], Encoder] = {}


class Encoder:
    """Encodes texts to the bytes of their ids (little-endian unsigned 32-bit).

    Pre-tokens never go past a blank or line feed between two visible characters, so texts are cut there. With
    ``blanks`` the blank belongs to the word after it (byte-level vocabularies); a text in which white space
    meets white space or an end is then encoded in one piece. Without, white space is dropped and letters are
    lower-cased. Letters followed by signs are two pre-tokens, so letters are encoded once for all signs. A text that
    holds the literal of a special token, which the tokenizer takes out before all else, is encoded in one piece; with
    ``plain`` these literals are ordinary text."""

    def __init__(self, path: str, blanks: bool, plain: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.blanks = blanks
        self.known: dict[str, bytes] = {}
        literals = [] if plain else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, literals)) or r"(?!)", re.IGNORECASE)  # any case: words are lower-cased
        self.opening = re.match(r"[^\w\s]*", os.path.commonprefix(literals))[0]  # found faster than the rest
        vocabulary = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(vocabulary.values()) + 1, bool)
        self.edge[[i for t, i in vocabulary.items() if (t.startswith("\u0120") if blanks else t.endswith("</w>"))]] = True

    def pieces(self, text: str) -> list[str]:
        """The parts of a text that are encoded each on their own; joined, their ids are those of the text."""
        if self.opening in text and self.added.search(text):
            return [text]
        if not self.blanks:
            if text.isascii() or _latin(text):  # lower case is then the same by any rule, letter by letter
                text = text.lower()
            return text.replace("\n", " ").split(" ")
        if _EDGES.search(text):
            return [text]
        return text.replace(" ", "\x01 ").replace("\n", "\x01\n\x01").split("\x01")

    def _whole(self, words: list[str]) -> list[bytes]:
        return [_packed(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> None:
        """Learn words of letters only; with ``blanks``, each after a blank. A word is one pre-token, whose first (or
        last) token is marked as such in the vocabulary."""
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [("" if self.blanks else " ").join(g) for g in groups]
        for group, got in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(got.ids, "<u4")
            marks = np.flatnonzero(self.edge[ids])
            if len(marks) != len(group):  # letters that the tokenizer does not see as such
                self.known.update(zip(group, self._whole(group), strict=True))
                continue
            data, ends = ids.tobytes(), (4 * (np.append(marks[1:], len(ids)) if self.blanks else marks + 1)).tolist()
            start = 0
            for word, end in zip(group, ends, strict=True):
                self.known[word] = data[start:end]
                start = end

    def _learn(self, words: set[str]) -> None:
        known, parts, letters, plain = self.known, [], set(), []
        for word in words:
            stem = word.rstrip(SIGNS)
            if (stem[1:] if stem[:1] == " " else stem).isalpha() and (stem[:1] == " " or not self.blanks):
                letters.add(stem)
                if len(stem) < len(word):
                    parts.append((word, stem, word[len(stem) :]))
            else:
                plain.append(word)
        signs = {s for _, _, s in parts}
        plain += [s for s in signs if s not in known]
        self._letters([w for w in letters if w not in known])
        known.update(zip(plain, self._whole(plain), strict=True))
        for word, stem, sign in parts:
            known[word] = known[stem] + known[sign]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        pieces = [self.pieces(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        wanted = set().union(*pieces).difference(known)
        long = {p for p in wanted if len(p) > 200}
        self._learn(wanted - long)
        out = []
        for doc in pieces:
            if long and not long.isdisjoint(doc):
                out.append(b"".join([known[p] if p in known else self._whole([p])[0] for p in doc]))
            else:
                out.append(b"".join(map(known.__getitem__, doc)))
        return out


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _packed(ids: list[int]) -> bytes:
    return b"".join([i.to_bytes(4, "little") for i in ids])


def encoder(name: str, blanks: bool, plain: bool = False) -> Encoder:
    """The worker's encoder for a vocabulary file of the public tokenizers, or for a path."""
    path = name if os.path.sep in name else public_tokenizers.path(name)
    key = path, blanks, plain
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]
