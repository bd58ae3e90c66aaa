import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from squadweave.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, text):
    return np.frombuffer(b"".join(encoder.runs(text)), "<u4").tolist()


def test_random_texts_agree_with_tiktoken(ranks, reference):
    encoder, pick = bpe.Encoder(ranks, PATTERN), random.Random(1)
    for _ in range(600):
        letters = pick.choice(["ab", "aab \n", "abcdefghijklmnopqrstuvwxyz", "éèñß中文😀a ", "0123456789", "*-=#/ "])
        text = "".join(pick.choice(letters) for _ in range(pick.choice([0, 3, 40, 200, 600])))
        assert ids_of(encoder, text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 20_000, "the" * 5000, " " * 30_000, "0" * 9999 + "abc" * 5000, "é" * 3000])
def test_long_pieces_join_as_they_would_merge_whole(ranks, reference, text):
    assert ids_of(bpe.Encoder(ranks, PATTERN), text) == reference.encode_ordinary(text)


def test_both_ways_to_merge_agree(ranks):
    encoder, pick = bpe.Encoder(ranks, PATTERN), random.Random(2)
    for _ in range(500):
        raw = bytes(pick.choice(b"abthe ") for _ in range(pick.randint(1, 150)))
        assert encoder.leaf(raw) == encoder.long_leaf(raw)


def test_every_code_point_splits_alike(ranks, reference):
    text = "".join("a" + chr(c) + " " + chr(c) for c in range(1, 0x3000))
    assert ids_of(bpe.Encoder(ranks, PATTERN), text) == reference.encode_ordinary(text)


def test_a_text_over_the_streaming_limit(ranks, reference):
    text = "some words, 123 and more\n" * 50_000
    assert ids_of(bpe.Encoder(ranks, PATTERN), text) == reference.encode_ordinary(text)


def test_forgetting_pieces_changes_nothing(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "one two three four five six one two three seven eight one"
    assert ids_of(bpe.Encoder(ranks, PATTERN), text) == reference.encode_ordinary(text)


def test_odd_documents(odd_docs, no_docs, reference):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    expected = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        ids = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
        expected.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest()))
    found = [tuple(r) for r in bpe.round_trip(odd_docs, PATH, PATTERN).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    assert bpe.round_trip(no_docs, PATH, PATTERN).collect() == []


def test_ids_decode_to_the_text(odd_docs):
    ids = bpe.encode(odd_docs, PATH, PATTERN)
    back = bpe.decode(ids, PATH)
    texts = sorted(bytes(r.decoded) for r in back.collect())
    assert texts == sorted((r.text or "").encode() for r in odd_docs.collect())
