from __future__ import annotations

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from fabpulse.llm import byte_bpe, words

PATTERN = public_tokenizers.PATTERN
RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODER = byte_bpe.Encoder(RANKS, PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={},
                              mergeable_ranks=ENCODER.merges.ranks)


def expected(text):
    return np.array(REFERENCE.encode_ordinary(text or ""), "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("  \n\t\x1c\x85 　﻿᠎​aabbeérs'tldvm12.!<|>日😀", max_size=40),
                max_size=6))
def test_ids_equal_tiktoken(texts):
    assert ENCODER.encode(texts) == list(map(expected, texts))


@pytest.mark.parametrize("text", ["a" * 5_001, "ab" * 3_000, "é" * 999, " " * 400, "x " * 200_000,
                                  "<|endoftext|> end", "\r\n \r\n", "it's they'll I'D"])
def test_long_runs(text):
    assert ENCODER.encode([text]) == [expected(text)]


def test_pairs_out_of_rank_order_fall_back():
    """A merge that makes a pair of lower rank than its own."""
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257, b"xy": 258, b"xyx": 259,
                                                   b"yx": 260, b"xyxy": 261, b"aa": 262}
    content = b"\n".join(base64.b64encode(t) + b" %d" % r for t, r in ranks.items())
    merges = byte_bpe.Merges(content)
    pieces = [b"zabc", b"abcabc", b"xyxyxyx", b"aaaaa", b"xabcyx", b"q", b"xyxyabcaa"]
    ids, ends = merges.replay(np.frombuffer(b"".join(pieces), np.uint8), np.array(list(map(len, pieces))))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [merges.alone(p) for p in pieces]


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(words, "KNOWN_CHUNKS", 5)
    monkeypatch.setattr(words, "GROUP_CHARS", 30)
    monkeypatch.setattr(byte_bpe, "NEW_CHUNKS", 3)
    encoder = byte_bpe.Encoder(RANKS, PATTERN)
    texts = [f"some words number {i} of {i * i}" for i in range(50)]
    assert encoder.encode(texts) == list(map(expected, texts))
    assert len(encoder.memory.known) < 40


def test_query_rows(documents):
    rows = [(1, "plain text"), (1, "plain text"), (2, None), (None, ""), (3, "日本語 " * 60_000)]
    found = byte_bpe.digests(byte_bpe.with_tokens(documents(*rows), RANKS, PATTERN)).collect()
    wanted = [(i, len(expected(t)) // 4, hashlib.sha256(expected(t)).hexdigest(),
               hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)


def test_empty_table_and_null_ids(documents, llm):
    docs = documents((1, "a"))
    assert byte_bpe.with_tokens(docs.limit(0), RANKS, PATTERN).count() == 0
    ids = llm.createDataFrame([(None,), (bytearray(expected("a b")),)], "ids binary")
    found = [r[0] for r in ids.select(byte_bpe.decoded(ids.ids, RANKS, PATTERN)).collect()]
    assert found == [None, b"a b"]


def test_memory_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(words, "KNOWN_BYTES", 50_000)
    monkeypatch.setattr(words, "GROUP_CHARS", 5_000)
    texts = [f"w{i} " * 20 + "漢字" * (50 + i) for i in range(400)]
    memory = words.ChunkMemory(lambda some: [chunk.encode() for chunk in some], 100)
    assert memory.encode(texts) == [text.encode() for text in texts]
    for known in (memory.known, memory.older):
        assert max(map(len, known)) <= words.LONGEST_KNOWN
        assert sum(4 * len(chunk) + len(code) + words.ENTRY_BYTES for chunk, code in known.items()) < 120_000
