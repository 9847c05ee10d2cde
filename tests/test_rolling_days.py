"""The rolling average by days equals that of a full run, whatever days are loaded in which order."""

from __future__ import annotations

import random
import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fabpulse.operators.rolling import rolling_avg_readings
from fabpulse.plans.gold import seed_tables
from fabpulse.plans.rolling import refresh_rolling_average
from fabpulse.schemas import TABLES
from fabpulse.sinks.day_files import NO_DAY
from fabpulse.sinks.tables import append_missing, ensure_table, replace_rows
from fabpulse.sources.tables import read_table

FACT = "fact_sensor_readings"
COLUMNS = ("machine_id", "reading_date", "reading_id", "average")


@pytest.fixture
def gold(spark, lake):
    ensure_table(spark, lake, FACT)
    seed_tables(spark, lake)
    return lake


def facts(spark, day, count, machines=3, sensor=1, seed=0, prefix=""):
    draw = random.Random(f"{day}-{seed}")
    made = []
    for n in range(count):
        ts = None if day is None else datetime(2024, 1, day) + timedelta(hours=draw.randrange(24))
        made.append((f"{prefix}{day}-{n:03}", 1, sensor, draw.random() * 100, ts, f"M{draw.randrange(machines)}",
                     "temperature", "NORMAL", "night", False, None, None))
    return spark.createDataFrame(made, TABLES[FACT].schema)


def load(spark, lake, *args, **how):
    return append_missing(spark, lake, FACT, facts(spark, *args, **how), [F.col("reading_ts")])


def averages(df):
    return rows(df.withColumn("average", F.round("rolling_avg_7d", 9)), *COLUMNS)


def same_as_whole(spark, lake, refreshed):
    whole = rolling_avg_readings(read_table(spark, lake, FACT), read_table(spark, lake, "dim_sensor"))
    assert averages(refreshed.averages) == averages(whole)


def test_days_in_any_order(spark, gold):
    for day, count in ((5, 40), (1, 9), (None, 8), (3, 4), (9, 30)):
        load(spark, gold, day, count)
        same_as_whole(spark, gold, refresh_rolling_average(spark, gold))


def test_only_days_within_reach_are_computed(spark, gold):
    for day, count in ((1, 60), (2, 60), (3, 6), (4, 60), (5, 60)):
        load(spark, gold, day, count)
    assert len(refresh_rolling_average(spark, gold).computed) == 5
    assert refresh_rolling_average(spark, gold).computed == frozenset()
    load(spark, gold, 2, 20, prefix="late")
    refreshed = refresh_rolling_average(spark, gold)
    # Day 3 has too few readings of each machine to keep day 2 from day 4.
    assert refreshed.computed == {"2024-01-02", "2024-01-03", "2024-01-04"}
    same_as_whole(spark, gold, refreshed)


def test_days_out_of_reach_are_not_read(spark, gold):
    for day in (1, 2, 3, 4):
        load(spark, gold, day, 60)
    refresh_rolling_average(spark, gold)
    load(spark, gold, 4, 5, prefix="new")
    for day in (1, 2, 3):
        for file in Path(gold.table(FACT), f"partition_day=2024-01-0{day}").glob("*.parquet"):
            file.write_bytes(b"unreadable")
    assert refresh_rolling_average(spark, gold).averages.count() == 245


def test_replaced_and_removed_days(spark, gold):
    for day in (1, 2, 3, None):
        load(spark, gold, day, 12)
    refresh_rolling_average(spark, gold)
    replace_rows(spark, gold, FACT, facts(spark, 2, 12, seed=1), [F.col("reading_ts")])
    same_as_whole(spark, gold, refresh_rolling_average(spark, gold))
    shutil.rmtree(Path(gold.table(FACT)) / "partition_day=2024-01-02")
    refreshed = refresh_rolling_average(spark, gold)
    assert {"2024-01-03", NO_DAY} & refreshed.computed and "2024-01-02" not in refreshed.computed
    same_as_whole(spark, gold, refreshed)


def test_other_sensors_and_no_readings(spark, gold):
    assert refresh_rolling_average(spark, gold).averages.count() == 0
    load(spark, gold, 1, 10, sensor=2)
    refreshed = refresh_rolling_average(spark, gold)
    assert refreshed.averages.count() == 0
    load(spark, gold, 1, 10, prefix="t")
    same_as_whole(spark, gold, refresh_rolling_average(spark, gold))
