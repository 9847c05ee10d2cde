"""Seed rows of the dimensions, and the generated calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.config import CALENDAR_END, CALENDAR_START, LOCATIONS, MACHINES, SENSORS
from fabpulse.schemas import TABLES
from fabpulse.sources.literal import literal_rows


def seed_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    seeds = {"dim_machine": MACHINES, "dim_sensor": SENSORS, "dim_location": LOCATIONS}
    return {name: literal_rows(spark, rows, TABLES[name].schema) for name, rows in seeds.items()}


def dim_date(
    spark: SparkSession, start: date = CALENDAR_START, end: date = CALENDAR_END,
) -> DataFrame:
    """One row per day, `end` excluded. Days of the week count from Sunday = 0."""
    day = F.col("full_date")
    weekday = F.dayofweek(day) - 1
    return (
        spark.range((end - start).days)
        .select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date"))
        .select(
            F.date_format(day, "yyyyMMdd").cast("int").alias("date_sk"),
            "full_date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.day(day).alias("day"),
            weekday.alias("day_of_week"),
            weekday.isin(0, 6).alias("is_weekend"),
        )
    )
