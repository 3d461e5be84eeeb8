"""Byte-level BPE against the tiktoken library and exact round trips."""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    return bpe.encoder(bpe.read_vocabulary(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed: bytes) -> list[int]:
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=4))
def test_any_text_is_encoded_as_the_library_does(coder, reference, texts):
    for text, packed in zip(texts, coder.encode_texts(texts), strict=True):
        assert ids(packed) == reference.encode_ordinary(text)
        assert coder.decode(packed) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "é" * 700, "x" * 64, "x" * 65, "<|endoftext|>", " \n\t ", "你好" * 400, "1234567890" * 50])
def test_long_pieces_use_one_tree(coder, reference, text):
    assert ids(next(coder.encode_texts([text]))) == reference.encode_ordinary(text)


def test_forgetting_pieces_changes_nothing(coder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    texts = ["one two three four", "five six seven", "one two nine", "four"]
    for _ in range(2):
        for text in texts:
            assert ids(next(coder.encode_texts([text]))) == reference.encode_ordinary(text)


def test_query_agrees_with_the_library(spark, reference, small_documents):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op2_byte_bpe"](spark, SMALL).collect()}
    assert got.keys() == small_documents.keys()
    for doc, text in small_documents.items():
        want = reference.encode_ordinary(text or "")
        packed = np.array(want, "<u4").tobytes()
        assert got[doc] == (len(want), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


def test_nulls_empty_texts_repeats_and_clashing_columns(spark, reference):
    rows = [(1, None, 5), (1, "same text", 5), (1, "same text", 5), (None, "", 6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, token_ids bigint").drop("token_ids")
    coded = bpe.encode(df, PATH, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, ids(r.token_ids)) for r in coded.collect()) == sorted(
        [(1, []), (1, reference.encode_ordinary("same text")), (1, reference.encode_ordinary("same text")), (0, [])])
    back = bpe.decode(coded, PATH)
    assert sorted(bytes(r.decoded) for r in back.collect()) == [b"", b"", b"same text", b"same text"]
    assert bpe.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
