from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fabpulse.llm import rans
from fabpulse.llm.queries import QUERIES

DEFINITION = open(public_tokenizers.path("byte_bpe_50k.json")).read()
TOKENIZER = Tokenizer.from_str(DEFINITION)
TOKENIZER.encode_special_tokens = True


def table_of(ids):
    values, counts = np.unique(ids, return_counts=True)
    return rans.Table.of_counts(values.astype(np.int64), counts)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 9_000), st.integers(1, 60_000), st.integers(0, 99))
def test_round_trip(size, symbols, seed):
    random = np.random.default_rng(seed)
    ids = (random.pareto(0.7, size) * 3).clip(0, symbols - 1).astype(np.uint32)
    table = table_of(ids)
    assert not size or table.frequencies.sum() == 1 << rans.PRECISION
    block = rans.CodedBlock(rans.encode_block(ids, table))
    assert (block.decode(table) == ids).all()


def test_parts_decode_on_their_own_and_near_the_entropy():
    random = np.random.default_rng(5)
    ids = random.geometric(0.02, 500_000).astype(np.uint32)
    table = table_of(ids)
    coded = rans.encode_block(ids, table)
    block = rans.CodedBlock(coded)
    assert block.checkpoints > 2
    at = block.every * block.lanes
    for c in reversed(range(block.checkpoints)):
        assert (block.decode_from(c, table) == ids[c * at:(c + 1) * at]).all()
    _, counts = np.unique(ids, return_counts=True)
    p = counts / counts.sum()
    assert len(coded) * 8 < 1.1 * len(ids) * -(p * np.log2(p)).sum()


def test_damage_is_noticed():
    ids = np.arange(3_000, dtype=np.uint32) % 50
    coded = bytearray(rans.encode_block(ids, table_of(ids)))
    coded[-5] ^= 4
    with pytest.raises(ValueError, match="damaged"):
        rans.CodedBlock(bytes(coded))


def test_rare_ids_keep_a_slot():
    counts = np.array([10**12] + [1] * 50_000)
    table = rans.Table.of_counts(np.arange(50_001), counts)
    assert table.frequencies.min() == 1 and table.frequencies.sum() == 1 << rans.PRECISION
    many = rans.Table.of_counts(np.arange(1 << 20), np.full(1 << 20, 3))
    assert (many.frequencies == 1).all()


def expected(rows, end=2):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for doc_id, text in ordered:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [end]
        yield doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("  \n\t\x1c\x85 　᠎​aabbeérs'tldvm12.,!<|>日😀", max_size=40),
                max_size=6))
def test_chunks_tokenise_as_whole_texts_do(texts):
    expected = [np.array(TOKENIZER.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert rans._tokenizer(DEFINITION).encode(texts) == expected


def test_store(documents, llm, tmp_path, monkeypatch):
    rows = [(i * 7 % 101, f"Text {i}  with <|endoftext|> é\n\n " * (i % 9)) for i in range(101)]
    rows += [(500, None), (501, ""), (502, "long text 日本 " * 30_000), (None, "no id")]
    rans.write_store(documents(*rows), f"{tmp_path}/store", DEFINITION, 2)
    found = rans.read_store(llm, f"{tmp_path}/store")
    assert sorted((tuple(r)[:4] for r in found.collect()), key=repr) == sorted(expected(rows), key=repr)
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in found.collect()}
    assert ids[502][:-1] == TOKENIZER.encode(rows[-2][1], add_special_tokens=False).ids


def test_repeated_rows_fill_the_range_without_gaps(documents, llm, tmp_path):
    rows = [(1, "b"), (1, "b"), (1, "a much longer text"), (None, None), (None, None), (1, None)] * 3
    rans.write_store(documents(*rows), f"{tmp_path}/store", DEFINITION, 2)
    found = sorted(rans.read_store(llm, f"{tmp_path}/store").collect(), key=lambda r: r.start)
    at = 0
    for row in found:
        assert row.start == at
        at += row.n_tokens
    assert [r.doc_id for r in found] == [None] * 6 + [1] * 12
    assert at == sum(n for _, _, n, _ in expected(rows))


def test_empty_store(documents, llm, tmp_path):
    rans.write_store(documents((1, "a")).limit(0), f"{tmp_path}/store", DEFINITION, 2)
    assert rans.read_store(llm, f"{tmp_path}/store").count() == 0


AS_LOADED = Tokenizer.from_str(DEFINITION)
WITH_TOKEN = ["ab <|endoftext|> c", "ab  <|endoftext|>  c", "<|endoftext|>", "a\n<|endoftext|>\n\nb, c.",
              " <|endoftext|><|endoftext|> x", "<|endoftext| >", "<|endoftext", "|> c", "words  without one", "", None]


def as_loaded(text):
    return AS_LOADED.encode(text or "", add_special_tokens=False).ids


def test_added_tokens_are_read_as_the_library_reads_them():
    assert as_loaded(WITH_TOKEN[0]) == [397, 220, 50256, 269]
    found = rans._tokenizer(DEFINITION, True).encode(WITH_TOKEN)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == list(map(as_loaded, WITH_TOKEN))


def test_a_token_made_of_two_lines_is_not_found_between_words():
    tokenizer = Tokenizer.from_str(DEFINITION)
    tokenizer.add_special_tokens(["b\nc"])
    texts = ["ab cd", "ab\ncd", "cd ab cd"]
    found = rans.ChunkTokenizer(tokenizer.to_str(), True).encode(texts)
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_reads_added_tokens(documents, llm, tmp_path):
    documents(*enumerate(WITH_TOKEN)).write.parquet(f"{tmp_path}/documents.parquet")
    start, wanted = 0, []
    for doc_id, text in enumerate(WITH_TOKEN):
        ids = [*as_loaded(text), 2]
        wanted.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = QUERIES["op10_rans_store"](llm, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == wanted


def test_without_ids_the_same_documents(llm, documents, tmp_path):
    docs = documents(*((i, "one two three " * (i % 5)) for i in range(60)), (None, "x"), (61, None))
    path = str(tmp_path / "store")
    rans.write_store(docs, path, DEFINITION, end_id=2)
    full, plain = rans.read_store(llm, path), rans.read_store(llm, path, with_ids=False)
    assert plain.columns == full.columns[:-1] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(plain.collect(), key=repr) == sorted(full.drop("ids").collect(), key=repr)


def test_each_distinct_chunk_is_looked_up_once(monkeypatch):
    tokenizer = rans.ChunkTokenizer(DEFINITION, True)
    asked, codes = [], tokenizer.memory.codes
    monkeypatch.setattr(tokenizer.memory, "codes", lambda chunks: asked.append(chunks) or codes(chunks))
    texts = ["the cat, the été\nthe \x00 dog", "the cat the cat. " * 50, "", None, "the  cat\n\n", " the ñandú日"]
    for _ in range(2):
        found = tokenizer.encode(texts)
        assert [np.frombuffer(f, "<u4").tolist() for f in found] == [
            TOKENIZER.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(asked) == 2 and all(len(set(chunks)) == len(chunks) for chunks in asked)
