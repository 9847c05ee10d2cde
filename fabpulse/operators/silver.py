"""Bronze messages to valid, deduplicated, flagged readings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabpulse.config import ANOMALY_THRESHOLDS
from fabpulse.functions.rules import exceeds_threshold, shift_of
from fabpulse.functions.typed import with_ingested_at, with_reading_ts, with_reading_value
from fabpulse.operators.dedup import first_per_key
from fabpulse.schemas import ARRIVAL_COLUMNS, FIRST, LATER, PLACE


def type_readings(messages: DataFrame, now: datetime | None = None) -> DataFrame:
    return with_ingested_at(with_reading_ts(with_reading_value(messages)), now)


def is_rejected() -> Column:
    """No usable value, or no id to deduplicate and key the fact table by.

    A missing timestamp is not a reason to reject.
    """
    return F.col("reading_value").isNull() | F.col("message_id").isNull()


def split_quarantine(typed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad)"""
    return typed.filter(~is_rejected()), typed.filter(is_rejected())


def delivery_order(df: DataFrame) -> list[Column]:
    """A total order of the deliveries of one message: by event time, then arrival.

    The hash of the message itself decides between copies that agree on both.
    """
    arrival = [F.col(c).asc_nulls_last() for c in ARRIVAL_COLUMNS if c in df.columns]
    content = [F.col(c) for c in df.columns if not c.startswith("_")]
    return [F.col("reading_ts").asc_nulls_last(), *arrival, F.xxhash64(*content)]


def dedup_readings(
    df: DataFrame, keys: Sequence[str] = ("message_id",), order_by: Sequence[Column] | None = None,
) -> DataFrame:
    return first_per_key(df, keys, order_by or delivery_order(df))


def daily_deliveries(typed: DataFrame) -> DataFrame:
    """Typed messages to Silver rows, one for each message and arrival day: its first delivery of that day."""
    good, _ = split_quarantine(typed)
    return with_shift(with_is_anomaly(dedup_readings(good, ("message_id", *ARRIVAL_COLUMNS))))


def with_place(deliveries: DataFrame) -> DataFrame:
    """Add whether a delivery is its message's first of all days; a message has at most one row a day."""
    order = Window.partitionBy("message_id").orderBy(*delivery_order(deliveries))
    return deliveries.withColumn(
        PLACE, F.when(F.row_number().over(order) == 1, FIRST).otherwise(LATER))


def with_is_anomaly(
    df: DataFrame, thresholds: Mapping[str, float] = ANOMALY_THRESHOLDS,
) -> DataFrame:
    flag = exceeds_threshold(F.col("reading_value"), F.col("sensor_type"), thresholds)
    return df.withColumn("is_anomaly", flag)


def with_shift(df: DataFrame) -> DataFrame:
    """The device's own shift is in local time, so it is replaced."""
    return df.withColumn("shift", shift_of(F.col("reading_ts")))


def refine(typed: DataFrame) -> DataFrame:
    """Typed messages to Silver rows."""
    good, _ = split_quarantine(typed)
    return with_shift(with_is_anomaly(dedup_readings(good)))
