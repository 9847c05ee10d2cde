"""The four business questions, and the readings of one sensor type."""

from __future__ import annotations

from calendar import monthrange
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabpulse.config import NORMAL, READING_INTERVAL_S, SENSORS_PER_MACHINE
from fabpulse.functions.days import as_date, in_month_of
from fabpulse.functions.rules import percent

SECONDS_PER_DAY = 86_400


def of_sensor(fact: DataFrame, dim_sensor: DataFrame, sensor: str) -> DataFrame:
    """Fact rows whose sensor dimension is of the given type."""
    wanted = dim_sensor.filter(F.col("sensor_type") == sensor).select("sensor_sk")
    return fact.join(wanted, "sensor_sk")


def hot_machines(fact: DataFrame, dim_sensor: DataFrame) -> DataFrame:
    """Per machine: highest temperature, readings reported HIGH, all readings."""
    return (
        of_sensor(fact, dim_sensor, "temperature")
        .groupBy("machine_id")
        .agg(
            F.max("reading_value").alias("max_temp"),
            F.count_if(F.col("status") == "HIGH").alias("high_count"),
            F.count(F.lit(1)).alias("total_readings"),
        )
        .orderBy(F.desc("high_count"), "machine_id")
    )


def uptime(
    fact: DataFrame, as_of: date | datetime,
    interval_s: float = READING_INTERVAL_S, sensors: int = SENSORS_PER_MACHINE,
) -> DataFrame:
    """Per machine: readings in the month of `as_of` against the number expected."""
    today = as_date(as_of)
    days = monthrange(today.year, today.month)[1]
    expected = F.lit(days * SECONDS_PER_DAY / interval_s * sensors)
    return (
        in_month_of(fact, "reading_ts", today)
        .groupBy("machine_id")
        .agg(F.count(F.lit(1)).alias("actual_readings"))
        .withColumn("uptime_pct", percent(F.col("actual_readings"), expected, 1))
        .orderBy(F.col("uptime_pct").asc_nulls_last(), "machine_id")
    )


def shift_anomaly_rate(fact: DataFrame) -> DataFrame:
    """Per shift: share of readings the device did not report as normal."""
    return (
        fact.groupBy("shift")
        .agg(
            F.count(F.lit(1)).alias("total_readings"),
            F.count_if(F.col("status") != NORMAL).alias("anomalies"),
        )
        .withColumn("anomaly_pct", percent(F.col("anomalies"), F.col("total_readings"), 2))
        .orderBy(F.col("anomaly_pct").desc_nulls_last(), "shift")
    )
