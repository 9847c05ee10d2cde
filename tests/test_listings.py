"""All listings of newest rows from one pass."""

from __future__ import annotations

from datetime import datetime, timedelta

from helpers import rows
from pyspark.sql import functions as F

from fabpulse.operators.dashboards import newest_by_listing
from fabpulse.plans.dashboards import datasets, first_days
from fabpulse.operators.dashboards import day_totals
from fabpulse.schemas import PARTITION_DAY, TABLES

LIMITS = {"temperature": 9, "vibration": 9, "pressure": 9, "power": 9, "live_readings": 9, "anomalies": 4}
SENSORS = ("temperature", "vibration", "pressure", "humidity", "live_readings", None)


def facts(spark, count=300):
    start = datetime(2024, 1, 1)
    made = []
    for n in range(count):
        ts = None if n % 29 == 0 else start + timedelta(hours=n % 100)  # ties and missing times
        made.append((f"r{n:03}", 1, 1, float(n), ts, "M", SENSORS[n % 6], "HIGH", "night",
                     None if n % 11 == 0 else n % 5 == 0, start, start))
    fact = spark.createDataFrame(made, TABLES["fact_sensor_readings"].schema)
    return fact.withColumn(PARTITION_DAY, F.to_date("reading_ts"))


def wanted(fact, name, limit):
    if name == "anomalies":
        fact = fact.filter("is_anomaly")
    elif name != "live_readings":
        fact = fact.filter(F.col("sensor_type") == name)
    return rows(fact.orderBy(F.col("reading_ts").desc_nulls_last(), "reading_id").limit(limit), "reading_id")


def test_equals_one_query_a_listing(spark):
    fact = facts(spark)
    found = newest_by_listing(fact, LIMITS)
    for name, limit in LIMITS.items():
        assert rows(found.filter(F.col("listing") == name), "reading_id") == wanted(fact, name, limit)


def test_first_days_change_nothing(spark):
    fact = facts(spark)
    firsts = {name: datetime(2024, 1, 4).date() for name in LIMITS} | {"anomalies": datetime(2024, 1, 2).date()}
    found = newest_by_listing(fact.repartition(7), LIMITS, firsts)
    for name, limit in LIMITS.items():
        assert rows(found.filter(F.col("listing") == name), "reading_id") == wanted(fact, name, limit)


def test_one_scan_and_a_limit_before_the_shuffle(spark, tmp_path):
    facts(spark).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    plan = newest_by_listing(fact, LIMITS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.index("Exchange hashpartitioning(listing") < plan.rindex("WindowGroupLimit")


def test_few_rows_and_none(spark):
    fact = facts(spark, 5)
    assert newest_by_listing(fact.limit(0), LIMITS).count() == 0
    assert set(first_days(day_totals(fact)).values()) == {None}
    assert datasets(fact)["live_readings"].count() == 5
