"""Ids are those of the tokenizer file with add_special_tokens=False and nothing else set, special tokens' literals included."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewind.llm import packing as K
from tradewind.llm import token_files as T
from tradewind.llm.encoding import Encoder


def stated_ids(name: str, text: str) -> bytes:
    return np.array(Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("name,blanks,inside", [(K.VOCABULARY, False, [862, 49407, 763]), (T.VOCABULARY, True, None)])
def test_special_literals_encode_as_the_tokenizer_does(name, blanks, inside):
    draw = random.Random(8)
    parts = ["see", "here", " ", " ", "\n", "  ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "é", "don't", "!", "🙂"]
    texts = ["see <|endoftext|> here"] + ["".join(draw.choice(parts) for _ in range(draw.randrange(12))) for _ in range(300)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert Encoder(public_tokenizers.path(name), blanks).encode(texts) == want
    if inside:
        assert np.frombuffer(want[0], "<u4").tolist() == inside


def test_special_literals_in_packing_and_token_files(spark):
    texts = ["see <|endoftext|> here", "<|startoftext|> <|EndOfText|>", "plain words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = {r.doc_id: r.ids for r in K.pack(docs, with_ids=True).collect()}
    assert packed == {i: stated_ids(K.VOCABULARY, t) + K.END_ID.to_bytes(4, "little") for i, t in enumerate(texts)}
    coded = {r.doc_id: r.ids_crc32 for r in T.round_trip(docs).collect()}
    assert coded == {i: zlib.crc32(stated_ids(T.VOCABULARY, t) + T.END_ID.to_bytes(4, "little")) for i, t in enumerate(texts)}
