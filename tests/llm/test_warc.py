from __future__ import annotations

import base64
import gzip
import hashlib
import random
from pathlib import Path

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fabpulse.llm import warc


def expected(rows, least=0):
    newest = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if page is not None:
            newest[payload] = max(newest.get(payload, page), page)
    counts = [(html or "").encode() for _, _, html in rows]
    for page, _, html in rows:
        payload = (html or "").encode()
        head = newest.get(payload)
        revisit = len(payload) >= least and counts.count(payload) > 1 and head is not None and head != page
        yield (page, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
               "revisit" if revisit else "response", head if revisit else None)


ROWS = [
    (1, "http://www.Example.com/b?x=1", "<p>one</p>"), (2, "http://example.com/a", "<p>one</p>"),
    (3, None, "WARC/1.1\r\n\r\n\r\nContent-Length: 9\r\n\r\n"), (4, "https://other.org/é\r\nX: y", ""),
    (5, "u", None), (None, "http://example.com/a", "<p>one</p>"), (None, "n", "nameless"),
    (None, "n", "nameless"), (7, "http://example.com/a/", "é日本\U0001f600\n" * 50_000),
    (8, "http://example.com/a", "twice"), (8, "http://example.com/a", "twice"), (6, "[bad", "twice"),
]


def pages(llm, rows):
    return llm.createDataFrame([(*r, "clash", 1) for r in rows],
                               "page_id long, url string, html string, record string, bytes int")


def test_round_trip(llm, tmp_path):
    for least, where in ((0, "all"), (7, "some")):
        warc.write_archives(pages(llm, ROWS), f"{tmp_path}/{where}", min_bytes=least)
        found = warc.capture_histories(llm, f"{tmp_path}/{where}")
        got = [tuple(r)[:5] for r in found.collect()]
        assert sorted(got, key=repr) == sorted(expected(ROWS, least), key=repr)


def test_archives_are_valid_and_places_point_into_them(llm, tmp_path):
    warc.write_archives(pages(llm, ROWS).repartition(3), f"{tmp_path}/w")
    rows = warc.capture_histories(llm, f"{tmp_path}/w").collect()
    assert None in {r.url for r in rows}
    for row in rows:
        raw = gzip.open(Path(tmp_path) / "w" / row.archive).read()
        (_, length, fields, _), = warc.walk(raw[row.offset:row.offset + row.length])
        assert length == row.length and fields["WARC-Type"] == row.record_type
        assert fields["WARC-Payload-Digest"] == f"sha1:{row.payload_digest}"


def test_histories_are_in_global_order(llm, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 100)
    rng = random.Random(1)
    rows = [(i, f"http://h{rng.randrange(6)}.com/{rng.randrange(3) if i % 3 else 'hot'}", f"page {i}")
            for i in range(900)]
    date = F.timestamp_seconds(F.col("page_id") * 37 % 1_000)
    warc.write_archives(pages(llm, rows), f"{tmp_path}/w", date=date)
    runs = warc.read_runs(llm, f"{tmp_path}/w")
    assert runs.select("archive").distinct().count() >= 9
    merged = sorted(warc.merge_runs(runs).collect(), key=lambda r: (r.stretch, r.position))
    keys = [(r.url_key, r.captured, r.page_id) for r in merged]
    assert keys == sorted(keys) and len(keys) == 900
    for at, row in enumerate(merged[1:]):
        assert row.position == (merged[at].position + 1 if row.stretch == merged[at].stretch else 0)


def test_empty_table(llm, tmp_path):
    warc.write_archives(pages(llm, ROWS).limit(0), f"{tmp_path}/w")
    assert warc.capture_histories(llm, f"{tmp_path}/w").count() == 0


@given(st.lists(st.lists(st.integers(0, 9)), max_size=9))
def test_loser_tree_merges(runs):
    runs = [[(x,) for x in sorted(run)] for run in runs]
    assert list(warc.LoserTree([iter(run) for run in runs])) == sorted(x for run in runs for x in run)


def test_url_keys():
    assert warc.url_key("HTTP://www.Example.com:80/A/b/?Q=1#f") == "com,example)/a/b?q=1"
    assert warc.url_key("https://m.x.org") == "org,x,m)/"
    assert warc.url_key(None) is None and warc.url_key("http://[oops") == "http://[oops"
