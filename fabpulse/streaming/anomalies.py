"""Capture of anomalies from the message stream, with dead letters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fabpulse.config import LANDING_INTERVAL, NORMAL
from fabpulse.functions.typed import audit_time, reading_ts, reading_value
from fabpulse.layout import Layout
from fabpulse.schemas import MESSAGE
from fabpulse.sinks.tables import append_missing, ensure_table

# Plain decimal numbers, NaN and infinities. The cast alone also takes Java's "1d".
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def judge(messages: DataFrame) -> DataFrame:
    """The payloads that matter: anomalies, and those that cannot be judged or converted.

    Adds the message fields as struct `m` and `error`, NULL for a valid anomaly. Anything
    but NORMAL is an anomaly, a JSON null included; a missing status is an error.
    """
    opened = messages.select(
        "payload",
        F.json_object_keys("payload").alias("fields"),
        F.from_json("payload", MESSAGE).alias("m"),
    )

    def missing(*names: str) -> Column:
        return F.coalesce(*[
            F.when(~F.array_contains("fields", name), f"missing field: {name}") for name in names
        ])

    parsed = opened.withColumns({
        "unreadable": F.coalesce(
            F.when(F.col("fields").isNull(), "not a JSON object"),
            missing("message_id", "status"),
        ),
        "incomplete": missing("machine_id", "sensor_type", "value", "ts"),
    })
    value, ts = F.col("m.value"), F.col("m.ts")
    unusable = F.coalesce(
        "incomplete",
        F.when(F.col("m.message_id").isNull(), "message_id is null"),
        F.when(value.isNull(), "value is null"),
        F.when(~value.rlike(NUMBER_TEXT), F.concat(F.lit("not a number: "), value)),
        F.when(ts.isNotNull() & reading_ts(ts).isNull(), F.concat(F.lit("not a time: "), ts)),
    )
    alarming = ~F.col("m.status").eqNullSafe(NORMAL)
    return parsed.filter(F.col("unreadable").isNotNull() | alarming).select(
        "payload", "m", F.coalesce("unreadable", unusable).alias("error")
    )


def anomaly_rows(judged: DataFrame, captured_at: datetime | None = None) -> DataFrame:
    return judged.filter(F.col("error").isNull()).select(
        F.col("m.message_id").alias("reading_id"),
        "m.machine_id", "m.sensor_type",
        reading_value(F.trim("m.value")).alias("reading_value"),
        "m.status",
        reading_ts(F.col("m.ts")).alias("reading_ts"),
        audit_time(captured_at).alias("captured_at"),
    )


def dead_letters(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("error").isNotNull()).select("error", "payload")


def write_anomaly_log(rows: DataFrame, layout: Layout) -> int:
    """Insert-or-ignore one micro-batch into the log."""
    content = [F.col(c) for c in rows.columns if c != "captured_at"]
    first = [F.col("reading_ts").asc_nulls_last(), F.xxhash64(*content)]
    return append_missing(rows.sparkSession, layout, "anomaly_log", rows, first)


def write_dead_letters(letters: DataFrame, batch_id: int, layout: Layout) -> None:
    """Write one micro-batch to a folder of its own, so that a replay overwrites it."""
    stream = letters.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    letters.write.mode("overwrite").json(f"{layout.dead_letters}/stream={stream}/batch={batch_id}")


def capture_anomalies(
    messages: DataFrame, layout: Layout, captured_at: datetime | None = None, **trigger,
) -> StreamingQuery:
    """Start the stream: anomalies to the log, everything unusable to dead letters.

    The log itself is what is known of ids seen. A micro-batch keeps one copy of each id, the first by
    event time, and joins its ids with the key column of the whole log, so a replay, a
    redelivery on another day or a new checkpoint folder adds no id twice. Both outputs come from
    one reading of the source; a micro-batch without dead letters writes none.
    """
    ensure_table(messages.sparkSession, layout, "anomaly_log")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_anomaly_log(anomaly_rows(batch, captured_at), layout)
            letters = dead_letters(batch)
            if not letters.isEmpty():
                write_dead_letters(letters, batch_id, layout)
        finally:
            batch.unpersist()

    return (
        judge(messages).writeStream.foreachBatch(write)
        .option("checkpointLocation", layout.checkpoint("anomalies"))
        .trigger(**(trigger or {"processingTime": LANDING_INTERVAL})).start()
    )
