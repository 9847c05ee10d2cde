"""The rolling average over readings, stored by day and refreshed for the days a load can change.

A reading's average needs the six readings before it, which may lie in earlier days. Of every machine and day the last
six are kept apart: a few rows, however many readings a day has. A changed day is averaged again from its own
readings and those kept of the days before it, and so are the days after it that its readings reach into: those with
fewer than six readings of a machine in between. No other reading is read, and nothing else is sorted.
Readings without a time come after all days.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabpulse.layout import Layout
from fabpulse.operators.business import of_sensor
from fabpulse.operators.rolling import ROLLING_READINGS, average_over, last_of_day, readings_of
from fabpulse.schemas import LAST_READINGS, PARTITION_DAY, ROLLING
from fabpulse.session import file_system, settle
from fabpulse.sinks.day_files import NO_DAY, files_by_day, in_days, store_names, stored_names
from fabpulse.sinks.files import replacing_partitions
from fabpulse.sources.literal import literal_rows
from fabpulse.sources.tables import read_table, table_or_none


@dataclass(frozen=True)
class Refreshed:
    """All averages, and the days that were computed, as named by their partitions."""

    averages: DataFrame
    computed: frozenset[str]


def refresh_rolling_average(spark: SparkSession, layout: Layout, sensor: str = "temperature") -> Refreshed:
    root = layout.rolling(sensor)
    table = table_or_none(spark, layout, "fact_sensor_readings")
    now = {} if table is None else files_by_day(table)
    before = stored_names(spark, root)
    changed = {day for day in now.keys() | before.keys() if now.get(day) != before.get(day)}
    computed = frozenset()
    if changed:
        fact = of_sensor(table, read_table(spark, layout, "dim_sensor"), sensor)
        series = readings_of(fact, PARTITION_DAY)
        reached = _reached(_kept(spark, root), changed)  # by what the days held before
        _replace(spark, last_of_day(series.filter(in_days(changed))).select(*LAST_READINGS.fieldNames()),
                 f"{root}/last", changed)
        kept = _kept(spark, root)
        computed = frozenset((changed | reached | _reached(kept, changed)) & now.keys())
        again = in_days(computed) if computed else F.lit(False)
        context = kept.filter(~F.coalesce(again, F.lit(False))).withColumn("_asked", F.lit(False))
        averages = average_over(
            series.filter(again).withColumn("_asked", F.lit(True)).unionByName(context), ROLLING_READINGS)
        _replace(spark, averages.filter("_asked").select(*ROLLING.fieldNames()), f"{root}/averages",
                 changed | computed)
        store_names(spark, root, now)
    return Refreshed(_stored(spark, f"{root}/averages", ROLLING), computed)


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    folder, files = file_system(spark, path)
    return spark.read.schema(schema).parquet(path) if files.exists(folder) else literal_rows(spark, [], schema)


def _kept(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/last", LAST_READINGS)


def _replace(spark: SparkSession, rows: DataFrame, path: str, days: set[str]) -> None:
    """Write the rows' days, and drop those of `days` that have none."""
    rows = settle(rows)
    replacing_partitions(rows, [PARTITION_DAY]).parquet(path)
    held = {NO_DAY if r[0] is None else r[0].isoformat() for r in rows.select(PARTITION_DAY).distinct().collect()}
    for day in set(days) - held:
        folder, files = file_system(spark, f"{path}/{PARTITION_DAY}={day}")
        files.delete(folder, True)


def _reached(kept: DataFrame, changed: set[str]) -> set[str]:
    """Later days whose first readings of some machine have readings of a changed day before them.

    Those are the days at whose start less than six readings of the machine have come since a changed day.
    One row per machine and day, of which the next changed day is looked for.
    """
    day = F.coalesce(F.col(PARTITION_DAY), F.lit("9999-12-31").cast("date"))
    per_day = kept.groupBy("machine_id", PARTITION_DAY).agg(F.count(F.lit(1)).alias("n"))
    counted = per_day.withColumns({"day": day, "changed": in_days(changed)})
    # A changed day counts for machines without readings in it too: it may have lost them.
    every = counted.select("machine_id").distinct()
    marked = every.withColumn("day", F.explode(F.array(*[F.lit(d) for d in sorted(changed)]))) \
        .select("machine_id", F.when(F.col("day") == NO_DAY, "9999-12-31").otherwise(F.col("day"))
                .cast("date").alias("day"), F.lit(0).cast("long").alias("n"), F.lit(True).alias("changed"))
    rows = counted.select("machine_id", "day", "n", "changed").unionByName(marked) \
        .groupBy("machine_id", "day").agg(F.sum("n").alias("n"), F.max("changed").alias("changed"))
    upto = Window.partitionBy("machine_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.withColumn("ahead", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    since = F.max(F.when(F.col("changed"), F.col("ahead") + F.col("n"))).over(upto)
    found = sums.withColumn("since", since).filter(
        F.col("since").isNotNull() & (F.col("ahead") - F.col("since") < ROLLING_READINGS - 1) & (F.col("n") > 0))
    return {NO_DAY if r[0].year == 9999 else r[0].isoformat() for r in found.select("day").distinct().collect()}
