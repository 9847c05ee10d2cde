"""Dashboard datasets over the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabpulse.config import ANOMALY_ROWS, ANOMALY_THRESHOLDS, DASHBOARD_ROWS
from fabpulse.functions.rules import lookup, percent, rounded, threshold_status
from fabpulse.schemas import PARTITION_DAY

# Output columns, by name.
COLUMNS = {
    "machine": "machine_id",
    "sensor": "sensor_type",
    "value": "coalesce(reading_value, 0D)",
    "ts": "cast(reading_ts AS string)",
    "is_anomaly": "coalesce(is_anomaly, false)",
    "status": "status",
    "shift": "shift",
}


def newest(readings: DataFrame, columns: Sequence[str | Column], limit: int) -> DataFrame:
    """The newest rows, by time and then id: a bounded heap per task, no full sort."""
    output = [F.expr(COLUMNS[c]).alias(c) if isinstance(c, str) else c for c in columns]
    return (
        readings.orderBy(F.col("reading_ts").desc_nulls_last(), "reading_id")
        .limit(limit)
        .select(*output)
    )


def newest_by_listing(
    fact: DataFrame, limits: Mapping[str, int], first_days: Mapping[str, date | None] | None = None,
) -> DataFrame:
    """The newest rows of every listing from one pass, with the name of their listing as `listing`.

    Listings are the sensor types among `limits`, `live_readings` (all rows) and `anomalies`. A row takes part in
    those it belongs to, from the first day that each needs. Every task keeps a listing's newest rows
    before anything is shuffled, so what meets in one place does not depend on the number of readings.
    """
    first_days = first_days or {}

    def member(name: str) -> Column:
        if name == "live_readings":
            belongs = F.lit(True)
        elif name == "anomalies":
            belongs = F.col("is_anomaly")
        else:
            belongs = F.col("sensor_type") == name
        first = first_days.get(name)
        recent = F.lit(True) if first is None else F.col(PARTITION_DAY) >= F.lit(first)
        return F.when(belongs & recent, F.lit(name))

    firsts = [first_days.get(name) for name in limits]
    if firsts and None not in firsts:  # prunes the partitions that no listing needs
        fact = fact.filter(F.col(PARTITION_DAY) >= F.lit(min(firsts)))
    order = Window.partitionBy("listing").orderBy(F.col("reading_ts").desc_nulls_last(), "reading_id")
    return (
        fact.withColumn("listing", F.explode(F.array_compact(F.array(*map(member, limits)))))
        .withColumn("_rank", F.row_number().over(order))
        .filter((F.col("_rank") <= max(limits.values()))
                & (F.col("_rank") <= lookup(F.col("listing"), limits)))
        .drop("_rank")
    )


def sensor_readings(fact: DataFrame, sensor: str, limit: int = DASHBOARD_ROWS) -> DataFrame:
    above = threshold_status(F.col("reading_value"), ANOMALY_THRESHOLDS[sensor])
    return newest(
        fact.filter(F.col("sensor_type") == sensor),
        ["machine", "value", "ts", "status", "is_anomaly", "shift", above.alias("threshold_status")],
        limit,
    )


def live_readings(fact: DataFrame, limit: int = DASHBOARD_ROWS) -> DataFrame:
    columns = ["machine", "sensor", "value", "ts", "status", "shift", "is_anomaly"]
    return newest(fact, columns, limit)


def anomalies(fact: DataFrame, limit: int = ANOMALY_ROWS) -> DataFrame:
    columns = ["machine", "sensor", "value", "status", "ts", "shift"]
    return newest(fact.filter("is_anomaly"), columns, limit)


def day_totals(fact: DataFrame) -> DataFrame:
    """One row per day, machine and sensor: what the aggregate datasets are made from."""
    day = F.col(PARTITION_DAY) if PARTITION_DAY in fact.columns else F.to_date("reading_ts")
    return fact.groupBy(
        day.alias("day"), F.col("machine_id").alias("machine"), F.col("sensor_type").alias("sensor"),
    ).agg(
        F.sum("reading_value").alias("value_sum"),
        F.count("reading_value").alias("value_count"),
        F.max("reading_value").alias("max_value"),
        F.min("reading_value").alias("min_value"),
        F.count(F.lit(1)).alias("total_readings"),
        F.count_if("is_anomaly").alias("anomaly_count"),
    )


def machine_totals(days: DataFrame) -> DataFrame:
    """One row per machine and sensor, from the day totals."""
    return days.groupBy("machine", "sensor").agg(
        F.try_divide(F.sum("value_sum"), F.sum("value_count")).alias("avg_value"),
        F.max("max_value").alias("max_value"),
        F.min("min_value").alias("min_value"),
        F.sum("total_readings").alias("total_readings"),
        F.sum("anomaly_count").alias("anomaly_count"),
    )


def machine_summary(totals: DataFrame) -> DataFrame:
    return totals.select(
        "machine", "sensor",
        *[rounded(F.col(c), 2).alias(c) for c in ("avg_value", "max_value", "min_value")],
        "total_readings", "anomaly_count",
        percent(F.col("anomaly_count"), F.col("total_readings"), 1).alias("anomaly_pct"),
    ).orderBy("machine", "sensor")


def anomaly_rate(totals: DataFrame) -> DataFrame:
    return (
        totals.groupBy("machine")
        .agg(
            F.sum("total_readings").alias("total"),
            F.sum("anomaly_count").alias("anomalies"),
        )
        .withColumn("anomaly_pct", percent(F.col("anomalies"), F.col("total"), 1))
        .orderBy(F.col("anomaly_pct").desc_nulls_last(), "machine")
    )


def export_counts(dataset: DataFrame) -> list[Column]:
    """Rows and flagged rows of a dataset; NULL where the dataset carries no flag."""
    flagged = (
        F.count_if("is_anomaly") if "is_anomaly" in dataset.columns
        else F.max(F.lit(None).cast("bigint"))
    )
    return [F.count(F.lit(1)).alias("row_count"), flagged.alias("anomaly_rows")]
