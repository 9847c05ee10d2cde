"""Rolling averages per machine: over readings, and over calendar days.

The average over readings needs each machine's readings in order, and one machine may hold a
large share of them, so a window per machine would be one endless task. All readings are put in
order by a range partitioning instead, which cuts a machine wherever its readings fill a
partition, and the window runs per machine and partition. That is final for all readings but the
first few of a machine in a partition, whose predecessors are the last few in partitions before.
These edges are few, so a second window, per machine, settles them. The result does not depend on
where the cuts are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabpulse.operators.business import of_sensor
from fabpulse.schemas import PARTITION_DAY
from fabpulse.session import settle

ROLLING_READINGS = 7
ROLLING_DAYS = 7

_LATEST = (1 << 63) - 1
_ORDER = ("_us", "reading_id")
_SERIES = ("machine_id", "reading_date", "reading_id", "_us")


def rolling_avg_readings(
    fact: DataFrame, dim_sensor: DataFrame, sensor: str = "temperature",
    readings: int = ROLLING_READINGS,
) -> DataFrame:
    """One row per reading: the mean of it and the readings just before it.

    Readings of a machine are ordered by time, then id; those without a time come last.
    This runs a job: the order of the readings is settled before anything is computed from it.
    """
    series = readings_of(of_sensor(fact, dim_sensor, sensor))
    return average_over(series, readings).orderBy("machine_id", *_ORDER).drop("_us")


def readings_of(fact: DataFrame, *extra: str) -> DataFrame:
    """What averages are made from, with time as a number, in which a missing one sorts last."""
    micros = F.unix_micros(F.col("reading_ts").cast("timestamp"))
    return fact.select(
        "machine_id", "reading_id", "reading_value", F.to_date("reading_ts").alias("reading_date"),
        F.coalesce(micros, F.lit(_LATEST)).alias("_us"), *extra)


def average_over(series: DataFrame, readings: int = ROLLING_READINGS) -> DataFrame:
    """The rows of `readings_of`, each with the mean of it and the readings just before it."""
    back = readings - 1
    extra = [c for c in series.columns if c not in ("reading_value", *_SERIES)]
    parts = in_order(series)
    in_part = Window.partitionBy("machine_id", "_part").orderBy(*_ORDER)
    in_machine = Window.partitionBy("machine_id").orderBy(*_ORDER)
    mean = F.avg("reading_value")
    parts = parts.select(
        *_SERIES, "reading_value", *extra,
        mean.over(in_part.rowsBetween(-back, 0)).alias("rolling_avg_7d"),
        (F.row_number().over(in_part) <= back).alias("_head"),
        F.lead("_us", back).over(in_part).isNull().alias("_tail"),
    )
    inner = parts.filter("NOT _head")
    # All of the `back` readings before a head are heads of its part or tails.
    heads = (
        parts.filter("_head OR _tail")
        .withColumn("rolling_avg_7d", mean.over(in_machine.rowsBetween(-back, 0)))
        .filter("_head")
    )
    columns = [*_SERIES, "rolling_avg_7d", *extra]
    return inner.select(*columns).unionByName(heads.select(*columns))


def last_of_day(series: DataFrame, readings: int = ROLLING_READINGS) -> DataFrame:
    """Of each machine and `partition_day` the last readings, which averages of later days may need."""
    order = Window.partitionBy("machine_id", PARTITION_DAY).orderBy(F.desc("_us"), F.desc("reading_id"))
    return series.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") < readings).drop("_rank")


def in_order(series: DataFrame) -> DataFrame:
    """The readings by machine, time and id, with the number of the range partition each is in."""
    ranges = series.repartitionByRange("machine_id", *_ORDER)
    return settle(ranges.withColumn("_part", F.spark_partition_id()))


def rolling_avg_days(
    fact: DataFrame, dim_sensor: DataFrame, sensor: str = "temperature", days: int = ROLLING_DAYS,
) -> DataFrame:
    """One row per machine and day: the mean of the daily means of the last `days` days.

    The window runs on one row per machine and day, whatever the number of readings.
    """
    back = days - 1
    day_number = F.unix_date("reading_date")
    window = Window.partitionBy("machine_id").orderBy(day_number).rangeBetween(-back, 0)
    return (
        of_sensor(fact, dim_sensor, sensor)
        .filter(F.col("reading_ts").isNotNull())
        .groupBy("machine_id", F.to_date("reading_ts").alias("reading_date"))
        .agg(F.avg("reading_value").alias("daily_avg"))
        .withColumn("rolling_avg_7d", F.avg("daily_avg").over(window))
        .orderBy("machine_id", "reading_date")
    )
