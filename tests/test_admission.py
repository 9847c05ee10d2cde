"""Bounded micro-batches, what is told of them, and the trigger by time."""

from __future__ import annotations

import time

import pytest
from helpers import message, publish, rows

from fabpulse.config import LANDING_INTERVAL
from fabpulse.sources.bronze import read_bronze
from fabpulse.sources.tables import read_table
from fabpulse.streaming.anomalies import capture_anomalies
from fabpulse.streaming.landing import write_bronze_stream
from fabpulse.streaming.progress import watching
from fabpulse.streaming.source import admission, read_reading_stream


def high(message_id, **changes):
    return message(message_id, status="HIGH", **changes)


def test_limits_by_source():
    assert admission("text", files=3, size="64m") == {"maxFilesPerTrigger": "3", "maxBytesPerTrigger": "64m"}
    assert admission("kafka", records=10_000, files=None) == {"maxOffsetsPerTrigger": "10000"}
    assert admission("text") == {}
    with pytest.raises(ValueError, match="kafka stream has no limit on files"):
        admission("kafka", files=1)


def test_one_file_a_batch_and_a_copy_in_a_later_one(spark, lake, tmp_path):
    topic = tmp_path / "topic"
    for n in range(4):
        publish(topic, high("again", value=str(n)), high(f"r{n}"))
        time.sleep(1.1)  # files are taken in the order of their times
    with watching(spark) as progress:
        stream = capture_anomalies(
            read_reading_stream(spark, str(topic), **admission("text", files=1)), lake, availableNow=True)
        stream.awaitTermination()
        until = time.time() + 20
        while sum(b.rows for b in progress.batches(str(stream.id))) < 8 and time.time() < until:
            time.sleep(0.2)  # the listener is told afterwards
        batches = [b for b in progress.batches(str(stream.id)) if b.rows]
    assert [b.rows for b in batches] == [2, 2, 2, 2]
    assert [b.number for b in batches] == [0, 1, 2, 3]
    log = read_table(spark, lake, "anomaly_log")
    assert rows(log, "reading_id", "reading_value") == [
        ("again", 0.0), ("r0", 50.0), ("r1", 50.0), ("r2", 50.0), ("r3", 50.0)]


def test_a_failed_stream_is_told(spark, lake, tmp_path):
    topic = tmp_path / "topic"
    publish(topic, high("a"))
    messages = read_reading_stream(spark, str(topic)).selectExpr("raise_error('broken') AS payload")
    with watching(spark) as progress:
        stream = write_bronze_stream(messages, lake, availableNow=True)
        with pytest.raises(Exception, match="broken"):
            stream.awaitTermination()
        until = time.time() + 20
        while str(stream.id) not in progress.failures and time.time() < until:
            time.sleep(0.2)
    assert "broken" in progress.failures[str(stream.id)]


def test_batches_by_time(spark, lake, tmp_path):
    """Messages wait for the next tick, and are landed at it without another message coming."""
    assert LANDING_INTERVAL == "60 seconds"
    topic = tmp_path / "topic"
    publish(topic, message("first"))
    stream = write_bronze_stream(read_reading_stream(spark, str(topic)), lake, processingTime="6 seconds")
    try:
        while not stream.recentProgress or not any(p["numInputRows"] for p in stream.recentProgress):
            assert stream.isActive
            time.sleep(0.1)
        publish(topic, message("second"), message("third"))
        stream.processAllAvailable()
        took = [p for p in stream.recentProgress if p["numInputRows"]]
        assert [p["numInputRows"] for p in took] == [1, 2]
    finally:
        stream.stop()
    assert rows(read_bronze(spark, lake.bronze), "message_id") == [("first",), ("second",), ("third",)]


def test_the_default_is_sixty_seconds(spark, lake, tmp_path):
    topic = tmp_path / "topic"
    publish(topic, message("first"))
    stream = write_bronze_stream(read_reading_stream(spark, str(topic)), lake)
    try:
        trigger = stream._jsq.streamingQuery() if hasattr(stream._jsq, "streamingQuery") else stream._jsq
        assert "60000" in trigger.trigger().toString()
    finally:
        stream.stop()
