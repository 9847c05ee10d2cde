"""Silver to the star schema."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fabpulse.layout import Layout
from fabpulse.operators.gold import fact_rows
from fabpulse.schemas import TABLES
from fabpulse.sinks.tables import append_missing, ensure_table
from fabpulse.sources.dimensions import dim_date, seed_dimensions
from fabpulse.sources.tables import read_silver, read_table


def seed_tables(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Insert the seed rows and the calendar, where missing."""
    seeds = {**seed_dimensions(spark), "dim_date": dim_date(spark)}
    return {
        name: append_missing(spark, layout, name, rows, [F.col(TABLES[name].key)])
        for name, rows in seeds.items()
    }


def build_gold(
    spark: SparkSession, layout: Layout, partitions: Iterable[date] | None = None,
    loaded_at: datetime | None = None,
) -> dict[str, int]:
    """Load the fact table from the given arrival days (all by default).

    Returns the number of rows inserted per table.
    """
    for name in TABLES:
        ensure_table(spark, layout, name)
    inserted = seed_tables(spark, layout)
    facts = fact_rows(
        read_silver(spark, layout.silver, partitions),
        read_table(spark, layout, "dim_machine"),
        read_table(spark, layout, "dim_sensor"),
        loaded_at,
    )
    first = [F.col("reading_ts").asc_nulls_last(), F.xxhash64("reading_value", "status", "shift")]
    inserted["fact_sensor_readings"] = append_missing(
        spark, layout, "fact_sensor_readings", facts, first
    )
    return inserted
