"""Hourly summaries of one event date."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from fabpulse.layout import Layout
from fabpulse.operators.rollup import hourly_rollup
from fabpulse.sinks.tables import replace_rows
from fabpulse.sources.tables import read_table


def run_hourly(spark: SparkSession, layout: Layout, target_date: date | None = None) -> int:
    """Upsert the summaries of a date, yesterday by default; returns how many.

    A date without readings writes nothing.
    """
    day = target_date or datetime.now(UTC).date() - timedelta(days=1)
    summaries = hourly_rollup(
        read_table(spark, layout, "fact_sensor_readings"),
        read_table(spark, layout, "dim_sensor"),
        day,
    )
    return replace_rows(spark, layout, "hourly_machine_summary", summaries, [F.col("hour_ts")])
