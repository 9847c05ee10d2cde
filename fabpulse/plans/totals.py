"""Totals per day, stored and refreshed for the days whose facts changed.

The aggregate datasets need sums, counts and extremes per machine and sensor, which add up from day to day. They are
stored one partition a day, next to the names of the fact files each day was made from. A load adds
files, a replacement exchanges them, both under new names: a day whose files are others is computed again, a
day without files is dropped, and of all other days no fact is read. What was computed is written
before the names are, so a run that fails in between computes the same days again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fabpulse.layout import Layout
from fabpulse.operators.dashboards import day_totals
from fabpulse.schemas import DAY_TOTALS
from fabpulse.session import file_system
from fabpulse.sinks.day_files import files_by_day, in_days, store_names, stored_names
from fabpulse.sinks.files import replacing_partitions
from fabpulse.sources.literal import literal_rows
from fabpulse.sources.tables import table_or_none

FACT = "fact_sensor_readings"


@dataclass(frozen=True)
class Refreshed:
    """The totals of all days, and the days that were computed and dropped, as named by their partitions."""

    totals: DataFrame
    computed: frozenset[str]
    dropped: frozenset[str]


def refresh_day_totals(spark: SparkSession, layout: Layout) -> Refreshed:
    fact = table_or_none(spark, layout, FACT)
    now = {} if fact is None else files_by_day(fact)
    before = stored_names(spark, layout.day_totals)
    computed = frozenset(day for day, files in now.items() if before.get(day) != files)
    dropped = frozenset(before.keys() - now.keys())
    if computed:
        changed = fact.filter(in_days(computed))
        replacing_partitions(day_totals(changed), ["day"]).parquet(f"{layout.day_totals}/days")
    for day in dropped:
        path, files = file_system(spark, f"{layout.day_totals}/days/day={day}")
        files.delete(path, True)
    if computed or dropped:
        store_names(spark, layout.day_totals, now)
    return Refreshed(_read_totals(spark, layout, bool(now)), computed, dropped)


def _read_totals(spark: SparkSession, layout: Layout, any_day: bool) -> DataFrame:
    if not any_day:
        return literal_rows(spark, [], DAY_TOTALS)
    return spark.read.schema(DAY_TOTALS).parquet(f"{layout.day_totals}/days")
