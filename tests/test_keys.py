"""The index of a table's keys: what it reads, and that the table stays the only truth."""

from __future__ import annotations

import shutil
from datetime import datetime
from pathlib import Path

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fabpulse.schemas import KEY_BUCKET, TABLES
from fabpulse.sinks import keys, tables
from fabpulse.sinks.keys import held_keys, key_bucket, open_index
from fabpulse.sinks.tables import append_missing, ensure_table
from fabpulse.sources.tables import read_table

LOG = "anomaly_log"


def batch(spark, ids, value=1.0, day=15):
    ts = datetime(2024, 1, day, 10)
    return spark.createDataFrame(
        [(i, "M", "temperature", value, "HIGH", ts, ts) for i in ids], TABLES[LOG].schema)


def insert(spark, lake, ids, **changes):
    return append_missing(spark, lake, LOG, batch(spark, ids, **changes), [F.col("reading_ts")])


@pytest.fixture
def log(spark, lake, monkeypatch):
    """A log of 600 keys, of which an index covers those of the first load."""
    ensure_table(spark, lake, LOG)
    monkeypatch.setattr(keys, "FRESH_FILES", 1)
    monkeypatch.setattr(open_index, "__defaults__", (1,))
    for day in (1, 2, 3):
        insert(spark, lake, [f"r{day}-{n}" for n in range(200)], day=day)
    open_index(spark, lake, LOG)
    return lake


def test_a_small_batch_reads_a_share_of_the_files(spark, log):
    index, _ = open_index(spark, log, LOG)
    every = len(index.inputFiles())
    assert every > 100
    asked = batch(spark, ["r1-7", "r2-9", "new"])
    found = held_keys(spark, log, LOG, asked)
    plan = found._jdf.queryExecution().toString()
    assert f"PartitionFilters: [{KEY_BUCKET}" in plan
    buckets = [r[0] for r in asked.select(key_bucket(F.col("reading_id"))).distinct().collect()]
    scanned = index.filter(F.col(KEY_BUCKET).isin(buckets)).select("_metadata.file_name").distinct().count()
    assert scanned <= 3 * every / len(index.select(KEY_BUCKET).distinct().collect()) < every / 10
    assert {r[0] for r in found.collect()} >= {"r1-7", "r2-9"}


def test_rows_are_inserted_once(spark, log):
    assert insert(spark, log, ["r1-0", "r3-199", "new", "new"], value=9.0, day=20) == 1
    assert insert(spark, log, ["new"], day=21) == 0
    table = read_table(spark, log, LOG)
    assert table.count() == 601
    assert table.filter("reading_value = 9").select("reading_id").first()[0] == "new"


def test_a_load_that_failed_before_the_index_knew_of_it(spark, log, monkeypatch):
    """Rows are in the table, and the next load must meet them although no index covers them."""
    insert(spark, log, ["late-1", "late-2"], day=9)

    def fail(*_):
        raise RuntimeError("no space")

    with monkeypatch.context() as broken:
        broken.setattr(keys, "_take_in", fail)
        with pytest.raises((RuntimeError, PySparkException)):
            insert(spark, log, ["more"], day=10)  # fails before it writes
    assert insert(spark, log, ["late-1", "late-2", "more", "r2-2"], day=25) == 1


def test_an_index_written_twice_does_no_harm(spark, log):
    files = read_table(spark, log, LOG).inputFiles()
    keys._take_in(spark, log, LOG, files)
    assert insert(spark, log, ["r1-1", "fresh"], day=22) == 1


def test_a_rewritten_table_gets_a_new_index(spark, log):
    shutil.rmtree(Path(log.table(LOG)) / "partition_day=2024-01-02")
    assert insert(spark, log, ["r2-5", "r1-5"], day=2) == 1
    assert sorted(r[0] for r in rows(read_table(spark, log, LOG).filter("reading_id LIKE 'r2%'"), "reading_id")) \
        == ["r2-5"]


def test_no_table_and_no_index(spark, lake):
    asked = batch(spark, ["a"])
    assert held_keys(spark, lake, LOG, asked).collect() == []
    assert tables.append_missing(spark, lake, LOG, asked.limit(0), [F.col("reading_ts")]) == 0
