import json
from datetime import UTC, datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from helpers import message, publish, rows
from fabpulse.sources.bronze import read_bronze
from fabpulse.sources.tables import read_table
from fabpulse.streaming import anomalies
from fabpulse.streaming.anomalies import capture_anomalies
from fabpulse.streaming.landing import write_bronze_stream
from fabpulse.streaming.source import read_reading_stream


@pytest.fixture
def topic(tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    return str(folder)


def capture(spark, lake, topic):
    capture_anomalies(read_reading_stream(spark, topic), lake, availableNow=True).awaitTermination()


def log(spark, lake, *columns):
    return rows(read_table(spark, lake, "anomaly_log"), *columns)


def letters(spark, lake):
    found = spark.read.schema("error STRING, payload STRING").json(lake.dead_letters)
    return rows(found, "error", "payload")


def without(name, **changes):
    body = message(**changes)
    del body[name]
    return body


def test_anomalies_and_dead_letters(spark, lake, topic):
    bad_number = message("n", value="n/a", status="HIGH")
    publish(
        topic,
        message("a", value=" 95.5 ", status="HIGH"), message("b"), message("c", status=None),
        without("status", message_id="d"), without("message_id", status="HIGH"),
        without("ts", message_id="t", status="HIGH"), without("ts", message_id="u"),
        bad_number, message("x", value="1d", status="WARN"), message(None, status="HIGH"),
        message("v", value=None, status="HIGH"), message("w", ts="bad", status="HIGH"),
        message("z", ts=None, status="WARN", value="inf"), message("y", value=12.5, status="HIGH"),
        "{bad json", "[1, 2]",
    )
    capture(spark, lake, topic)
    assert log(spark, lake, "reading_id", "reading_value", "status") == [
        ("a", 95.5, "HIGH"), ("c", 50.0, None), ("y", 12.5, "HIGH"), ("z", float("inf"), "WARN")]
    errors = letters(spark, lake)
    assert [e for e, _ in errors] == sorted([
        "missing field: status", "missing field: message_id", "missing field: ts",
        "not a number: n/a", "not a number: 1d", "message_id is null", "value is null",
        "not a time: bad", "not a JSON object", "not a JSON object"])
    assert json.loads(dict(errors)["not a number: n/a"]) == bad_number
    assert "{bad json" in [payload for _, payload in errors]


def test_restart_and_redelivery(spark, lake, topic):
    first = message("a", status="HIGH", value="95")
    publish(topic, first, first, message("n", value="n/a", status="HIGH"))
    capture(spark, lake, topic)
    publish(topic, first, {**first, "value": "99", "ts": "2024-03-01T00:00:00+00:00"},
            message("b", status="WARN"), message("n", value="70", status="HIGH"))
    capture(spark, lake, topic)
    assert log(spark, lake, "reading_id", "reading_value") == [("a", 95.0), ("b", 50.0), ("n", 70.0)]
    assert len(letters(spark, lake)) == 1


def test_a_new_stream_respects_the_log(spark, lake, topic, monkeypatch):
    publish(topic, message("a", status="HIGH"), "{bad json")
    capture(spark, lake, topic)
    monkeypatch.setattr(type(lake), "checkpoint", lambda self, s: f"{self.root}/second/{s}")
    publish(topic, message("b", status="HIGH"))
    capture(spark, lake, topic)
    assert log(spark, lake, "reading_id") == [("a",), ("b",)]
    assert len(letters(spark, lake)) == 2


def test_a_failed_batch_is_replayed(spark, lake, topic, monkeypatch):
    publish(topic, message("a", status="HIGH"), message("b", status="HIGH"))
    write = anomalies.append_missing

    def write_then_fail(*args, **kwargs):
        write(*args, **kwargs)
        raise OSError("lost after the write, before the commit")

    monkeypatch.setattr(anomalies, "append_missing", write_then_fail)
    with pytest.raises(StreamingQueryException):
        capture(spark, lake, topic)
    monkeypatch.setattr(anomalies, "append_missing", write)
    publish(topic, message("b", status="HIGH"), message("c", status="HIGH"))
    capture(spark, lake, topic)
    assert log(spark, lake, "reading_id") == [("a",), ("b",), ("c",)]


def land_stream(spark, lake, topic):
    stream = read_reading_stream(spark, topic)
    write_bronze_stream(stream, lake, files_per_batch=1, availableNow=True).awaitTermination()


def test_a_failed_landing_is_replayed(spark, lake, topic):
    publish(topic, message("a"), message("b"))
    blocker = Path(lake.bronze) / f"year={datetime.now(UTC).year}"
    blocker.parent.mkdir(parents=True)
    blocker.write_text("in the way")
    with pytest.raises(StreamingQueryException):
        land_stream(spark, lake, topic)
    blocker.unlink()
    publish(topic, message("c"))
    land_stream(spark, lake, topic)
    assert rows(read_bronze(spark, lake.bronze), "message_id") == [("a",), ("b",), ("c",)]


def test_landing_appends_each_message_once(spark, lake, topic):
    publish(topic, message("a"), "{bad json")
    land_stream(spark, lake, topic)
    publish(topic, message("b"))
    land_stream(spark, lake, topic)
    land_stream(spark, lake, topic)
    bronze = read_bronze(spark, lake.bronze)
    assert rows(bronze, "message_id", "_corrupt_record") == [
        ("a", None), ("b", None), (None, "{bad json")]
    assert bronze.select("year", "month", "day").distinct().count() == 1
