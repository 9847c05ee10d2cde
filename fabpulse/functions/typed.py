"""Text to typed values. Malformed text becomes NULL, never an error."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reading_value(text: Column) -> Column:
    return text.try_cast("double")


def reading_ts(text: Column) -> Column:
    """ISO-8601 text to a timestamp; text without a zone is UTC."""
    return F.try_to_timestamp(text)


def with_reading_value(df: DataFrame) -> DataFrame:
    return df.withColumn("reading_value", reading_value(F.col("value")))


def with_reading_ts(df: DataFrame) -> DataFrame:
    return df.withColumn("reading_ts", reading_ts(F.col("ts")))


def audit_time(now: datetime | None = None) -> Column:
    """The passed moment, or the start of the query."""
    return F.current_timestamp() if now is None else F.lit(now).cast("timestamp")


def with_ingested_at(df: DataFrame, now: datetime | None = None) -> DataFrame:
    return df.withColumn("_ingested_at", audit_time(now))
