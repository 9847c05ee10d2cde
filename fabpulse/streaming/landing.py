"""Landing of raw messages as Bronze files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fabpulse.config import LANDING_INTERVAL
from fabpulse.layout import Layout
from fabpulse.schemas import ARRIVAL_COLUMNS


def write_bronze_stream(
    messages: DataFrame, layout: Layout, files_per_batch: int | None = None, **trigger,
) -> StreamingQuery:
    """Append payloads as lines below the UTC day of their micro-batch.

    A failed micro-batch is replayed from the checkpoint, with the same timestamp, and
    the file sink publishes it once. `files_per_batch` bounds the number of files where
    the source has many partitions.
    """
    arrival = {
        column: F.date_format(F.current_timestamp(), pattern)
        for column, pattern in zip(ARRIVAL_COLUMNS, ("yyyy", "MM", "dd"), strict=True)
    }
    # One message per line: outside of JSON strings a line break is only white space,
    # and inside of them it cannot occur.
    line = F.regexp_replace("payload", r"[\r\n]+", " ").alias("value")
    lines = messages.select(line).withColumns(arrival)
    if files_per_batch:
        lines = lines.coalesce(files_per_batch)
    return (
        lines.writeStream.format("text").partitionBy(*ARRIVAL_COLUMNS)
        .option("checkpointLocation", layout.checkpoint("bronze"))
        .trigger(**(trigger or {"processingTime": LANDING_INTERVAL}))
        .start(layout.bronze)
    )
