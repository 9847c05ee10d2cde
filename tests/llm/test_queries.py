"""The registered queries over whole tables, against SQL, brute force or held-out labels."""

from __future__ import annotations

import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from test_quality_rules import brute_counts
from test_rans import expected as expected_store
from test_sharding import check_law
from test_simhash import brute_classes, brute_fingerprint
from test_warc import expected as expected_pages

from fabpulse.llm import byte_bpe
from fabpulse.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def table(llm, name, *columns):
    return [tuple(r) for r in llm.read.parquet(f"{SF_DIR}/{name}.parquet").select(*columns).collect()]


def result(llm, name):
    return QUERIES[name](llm, SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(llm, name):
    con = duckdb.connect()
    for source in ("documents", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {source} AS FROM '{SF_DIR}/{source}.parquet'")
    found, wanted = result(llm, name), con.sql(ORACLES[name])
    assert found.columns == wanted.columns
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(wanted.fetchall(), key=repr)


def test_op1(llm):
    found = {r[0]: tuple(r)[1:] for r in result(llm, "op1_quality_rules").collect()}
    for doc_id, text in table(llm, "documents", "doc_id", "text"):
        counts = brute_counts(text)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert found[doc_id][:6] == (*counts, failed) and not (failed and found[doc_id][6])


def test_op2(llm):
    langs = dict(table(llm, "documents", "doc_id", "lang"))
    rows = result(llm, "op2_language_id").collect()
    assert {r.doc_id for r in rows} == set(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]) > 0.9


def test_op3(llm):
    docs = sorted(table(llm, "documents", "doc_id", "text"))
    prints = [brute_fingerprint(t) for _, t in docs]
    least = [docs[k][0] for k in brute_classes(prints)]
    assert sorted(map(tuple, result(llm, "op3_simhash_dedup").collect())) == [
        (i, f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, least)]


def test_op4(llm):
    pages = table(llm, "pages", "page_id", "url", "html")
    found = [tuple(r)[:5] for r in result(llm, "op4_warc").collect()]
    assert sorted(found) == sorted(expected_pages(pages))


def test_op7(llm):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                 mergeable_ranks=byte_bpe.Merges(ranks).ranks)
    wanted = []
    for doc_id, text in table(llm, "documents", "doc_id", "text"):
        ids = encoding.encode_ordinary(text or "")
        wanted.append((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, result(llm, "op7_byte_bpe").collect())) == sorted(wanted)


def test_op9(llm):
    found = check_law(result(llm, "op9_sharding").collect())
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == sorted(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
        for i, t in table(llm, "documents", "doc_id", "text"))


def test_op10(llm):
    found = sorted(map(tuple, result(llm, "op10_rans_store").collect()))
    assert found == list(expected_store(table(llm, "documents", "doc_id", "text")))
