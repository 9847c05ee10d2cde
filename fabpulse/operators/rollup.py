"""Hourly summary per machine and sensor."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabpulse.config import NORMAL
from fabpulse.functions.days import on_day, start_of_hour
from fabpulse.functions.rules import summary_id


def hourly_rollup(
    fact: DataFrame, dim_sensor: DataFrame, target_date: date | None = None,
) -> DataFrame:
    """Summary rows of one event date, or of all dates that have a timestamp."""
    known = dim_sensor.select("sensor_sk")
    readings = (
        fact.filter(F.col("reading_ts").isNotNull()) if target_date is None
        else on_day(fact, "reading_ts", target_date)
    )
    return (
        readings.join(known, "sensor_sk")
        .groupBy("machine_id", "sensor_type", start_of_hour(fact, "reading_ts").alias("hour_ts"))
        .agg(
            F.avg("reading_value").alias("avg_value"),
            F.min("reading_value").alias("min_value"),
            F.max("reading_value").alias("max_value"),
            F.count_if(F.col("status") != NORMAL).cast("int").alias("anomaly_count"),
            F.count(F.lit(1)).cast("int").alias("reading_count"),
        )
        .select(
            summary_id(F.col("machine_id"), F.col("sensor_type"), F.col("hour_ts"))
            .alias("summary_id"),
            "machine_id", "sensor_type", "hour_ts", "avg_value", "min_value", "max_value",
            "anomaly_count", "reading_count",
        )
    )
