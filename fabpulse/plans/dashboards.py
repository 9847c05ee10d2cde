"""The eight dashboard datasets."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fabpulse.config import ANOMALY_ROWS, ANOMALY_THRESHOLDS, DASHBOARD_ROWS
from fabpulse.layout import Layout
from fabpulse.operators.dashboards import (
    anomalies, anomaly_rate, day_totals, export_counts, live_readings, machine_summary,
    machine_totals, newest_by_listing, sensor_readings,
)
from fabpulse.plans.totals import refresh_day_totals
from fabpulse.session import observing, settle
from fabpulse.sinks.files import write_dashboard
from fabpulse.sources.tables import read_table

# How many newest rows each listing shows.
LISTINGS = {
    **dict.fromkeys(ANOMALY_THRESHOLDS, DASHBOARD_ROWS),
    "live_readings": DASHBOARD_ROWS,
    "anomalies": ANOMALY_ROWS,
}


def datasets(fact: DataFrame) -> dict[str, DataFrame]:
    """All eight datasets of a fact DataFrame."""
    return _datasets(dict.fromkeys(LISTINGS, fact), day_totals(fact))


def _datasets(facts: Mapping[str, DataFrame], days: DataFrame) -> dict[str, DataFrame]:
    totals = machine_totals(days)
    return {
        **{sensor: sensor_readings(facts[sensor], sensor) for sensor in ANOMALY_THRESHOLDS},
        "live_readings": live_readings(facts["live_readings"]),
        "anomalies": anomalies(facts["anomalies"]),
        "machine_summary": machine_summary(totals),
        "anomaly_rate": anomaly_rate(totals),
    }


def first_days(days: DataFrame) -> dict[str, date | None]:
    """For each listing, the latest day from which on there are enough rows to fill it.

    All rows of earlier days are older, and rows without a day come last, so the listing
    needs none of them. None where the whole table holds too few rows.
    """
    counted: dict[str, Column] = {
        sensor: F.when(F.col("sensor") == sensor, F.col("total_readings"))
        for sensor in ANOMALY_THRESHOLDS
    }
    counted["live_readings"] = F.col("total_readings")
    counted["anomalies"] = F.col("anomaly_count")
    # One row per day of the calendar, however many readings there are.
    per_day = (
        days.filter(F.col("day").isNotNull()).groupBy("day")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(name) for name, n in counted.items()])
        .orderBy(F.desc("day")).collect()
    )
    firsts: dict[str, date | None] = dict.fromkeys(LISTINGS)
    for name, limit in LISTINGS.items():
        rows = 0
        for row in per_day:
            rows += row[name]
            if rows >= limit:
                firsts[name] = row["day"]
                break
    return firsts


def build_dashboards(spark: SparkSession, layout: Layout) -> dict[str, dict[str, int | None]]:
    """Write the datasets of the stored fact table; returns rows and anomalies of each.

    The day totals are read as stored, after those of days that changed were computed again. They give both
    aggregates, and the day partitions to which each listing of newest rows can confine itself; so of days that are
    neither changed nor among the newest no fact is read, and the newest are read once for all six listings.
    """
    fact = read_table(spark, layout, "fact_sensor_readings")
    days = refresh_day_totals(spark, layout).totals
    # As many rows as the listings show, whatever the table holds.
    newest = settle(newest_by_listing(fact, LISTINGS, first_days(days)))
    facts = {name: newest.filter(F.col("listing") == name) for name in LISTINGS}
    stats = {}
    for name, dataset in _datasets(facts, days).items():
        written = Observation()
        counts = export_counts(dataset)
        with observing(spark):
            write_dashboard(dataset.observe(written, *counts), layout.dashboards, name)
        stats[name] = {"rows": written.get["row_count"], "anomalies": written.get["anomaly_rows"]}
    return stats
