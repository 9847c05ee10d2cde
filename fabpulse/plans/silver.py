"""Bronze to Silver, with quarantine."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fabpulse.layout import Layout
from fabpulse.operators.silver import (
    daily_deliveries, is_rejected, split_quarantine, type_readings, with_place,
)
from fabpulse.schemas import ARRIVAL_COLUMNS, CORRUPT_RECORD, DELIVERIES, FIRST, LATER, PLACE
from fabpulse.session import file_system, observing, settle
from fabpulse.sinks.files import drop_days, write_deliveries, write_quarantine
from fabpulse.sources.bronze import arrival_date, read_bronze


def build_silver(
    spark: SparkSession, layout: Layout,
    partitions: Iterable[date] | None = None, now: datetime | None = None,
) -> dict[str, int]:
    """Rebuild Silver and quarantine for the given arrival days (all by default).

    Runs over some days leave the same Silver as one run over all of them: a message keeps its
    first delivery, whichever day that arrived on, and days that lost all rows are emptied.

    Returns run metrics. They are observed while Silver is written, so no pass is made for them;
    a task that runs again after an executor was lost can be counted twice, the files hold its rows
    once.
    """
    days = None if partitions is None else sorted(set(partitions))
    typed = type_readings(read_bronze(spark, layout.bronze, days), now)
    read = Observation()
    rows = daily_deliveries(
        typed.observe(
            read,
            F.count(F.lit(1)).alias("input_rows"),
            F.count_if(is_rejected()).alias("quarantined"),
            F.count_if(~is_rejected() & F.col("reading_ts").isNull()).alias("undated"),
            F.collect_set(F.when(is_rejected(), arrival_date())).alias("rejected_days"),
        )
    ).drop(CORRUPT_RECORD)
    with observing(spark):
        if days is None:
            written = Observation()
            first = F.col(PLACE) == FIRST
            write_deliveries(with_place(rows).observe(
                written,
                F.count_if(first).alias("silver_rows"),
                F.size(F.collect_set(F.when(first, F.struct(*ARRIVAL_COLUMNS)))).alias("partitions"),
            ), layout.deliveries)
            metrics = {**read.get, **written.get}
        else:
            counts = _merge_days(spark, layout, settle(rows), days)
            metrics = {**read.get, **counts}
    rejected_days = metrics.pop("rejected_days")
    # The same frame, so the same files as were counted above.
    bad = split_quarantine(typed)[1].filter(arrival_date().isin(rejected_days))
    if days is None or rejected_days:
        write_quarantine(bad, layout.quarantine, days)
    if days is not None:
        drop_days(spark, layout.quarantine, set(days).difference(rejected_days))
    metrics["duplicates"] = (
        metrics["input_rows"] - metrics["quarantined"] - metrics["silver_rows"]
    )
    return metrics


def _merge_days(
    spark: SparkSession, layout: Layout, rows: DataFrame, days: list[date],
) -> dict[str, int]:
    """Write the deliveries of some arrival days, against those that are stored of others.

    Every message of these days, before or now, has its first delivery chosen anew among those of all days; the
    stored ones that are not first are kept for that, so no other day is read from Bronze. Of
    the other days only the keys and times are read, and those rewritten in which a delivery changes its place.
    """
    stored = _deliveries_or_empty(spark, layout)
    here = arrival_date().isin(days)
    asked = rows.select("message_id").union(stored.filter(here).select("message_id")).distinct()
    others = stored.filter(~here).select("message_id", *_delivery(), PLACE).join(asked, "message_id", "left_semi")
    delivery = F.struct("undated", "reading_ts", "arrived")
    best = settle(
        others.drop(PLACE).unionByName(rows.select("message_id", *_delivery()))
        .groupBy("message_id").agg(F.min(delivery).alias("best")).select("message_id", "best.arrived"))
    placed = rows.join(best.withColumnRenamed("arrived", "_best"), "message_id").withColumn(
        PLACE, F.when(arrival_date() == F.col("_best"), FIRST).otherwise(LATER)).drop("_best")
    moved = settle(
        others.join(best.withColumnRenamed("arrived", "_best"), "message_id")
        .withColumn("_place", F.when(F.col("arrived") == F.col("_best"), FIRST).otherwise(LATER))
        .filter(F.col("_place") != F.col(PLACE)).select("message_id", "arrived", "_place"))
    # One row per day of the calendar at most.
    changed = [r[0] for r in moved.select("arrived").distinct().collect()]
    rebuilt = (
        stored.filter(arrival_date().isin(changed)).withColumn("arrived", arrival_date())
        .join(moved, ["message_id", "arrived"], "left")
        .withColumn(PLACE, F.coalesce("_place", PLACE)).drop("_place", "arrived"))
    columns = DELIVERIES.fieldNames()
    # Settled before the write, which replaces the very files `stored` reads.
    result = settle(placed.select(*columns).unionByName(rebuilt.select(*columns)))
    counted = {(r[PLACE], r["day"]): r["count"]
               for r in result.groupBy(PLACE, arrival_date().alias("day")).count().collect()}
    if counted:
        write_deliveries(result, layout.deliveries, days)
    for place in (FIRST, LATER):
        held = {day for of, day in counted if of == place}
        drop_days(spark, f"{layout.deliveries}/{PLACE}={place}", {*days, *changed}.difference(held))
    ours = {day: n for (place, day), n in counted.items() if place == FIRST and day in days}
    return {"silver_rows": sum(ours.values()), "partitions": len(ours)}


def _delivery() -> list[Column]:
    """What orders deliveries that arrived on different days; no time comes last."""
    return [F.col("reading_ts").isNull().alias("undated"), "reading_ts",
            arrival_date().alias("arrived")]


def _deliveries_or_empty(spark: SparkSession, layout: Layout) -> DataFrame:
    path, files = file_system(spark, layout.deliveries)
    if files.exists(path):
        return spark.read.schema(DELIVERIES).parquet(layout.deliveries)
    return spark.createDataFrame([], DELIVERIES)
