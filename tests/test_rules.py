import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fabpulse.functions import rules
from fabpulse.functions.days import month_bounds
from fabpulse.functions.typed import with_ingested_at
from fabpulse.operators.dashboards import live_readings, sensor_readings
from fabpulse.operators.silver import type_readings, with_is_anomaly, with_shift


def test_threshold_is_strict_and_unknown_sensors_are_normal(spark):
    df = spark.createDataFrame(
        [("temperature", 90.0), ("temperature", 90.01), ("humidity", 1000.0),
         ("power", None), ("pressure", math.nan), ("vibration", math.inf)],
        "sensor_type string, reading_value double",
    )
    flags = [r.is_anomaly for r in with_is_anomaly(df).collect()]
    assert flags == [False, True, False, False, True, True]
    lowered = with_is_anomaly(df, {"humidity": 5.0}).collect()
    assert [r.is_anomaly for r in lowered] == [False, False, True, False, False, False]


@pytest.mark.parametrize(("time", "shift"), [
    ("05:59:59", "night"), ("06:00:00", "morning"), ("13:59:59", "morning"),
    ("14:00:00", "afternoon"), ("21:59:59", "afternoon"), ("22:00:00", "night"),
])
def test_shift_borders(spark, time, shift):
    df = spark.sql(f"SELECT timestamp'2024-01-15 {time}' AS reading_ts, 'device' AS shift")
    assert with_shift(df).first().shift == shift


def test_shift_without_time_is_night(spark):
    df = spark.sql("SELECT cast(null AS timestamp) AS reading_ts")
    assert with_shift(df).first().shift == "night"


def test_device_status(spark):
    df = spark.createDataFrame(
        [("temperature", 90.0), ("temperature", 91.0), ("pressure", 161.0),
         ("vibration", 16.0), ("power", 61.0), ("humidity", 1e6)], "s string, v double",
    )
    got = [r[0] for r in df.select(rules.device_status(F.col("v"), F.col("s"))).collect()]
    assert got == ["NORMAL", "HIGH", "HIGH", "WARN", "WARN", "NORMAL"]


def test_value_texts(spark):
    texts = ["", "abc", None, " 2 ", "1e3", "NaN", "Infinity"]
    df = spark.createDataFrame([(t, "x") for t in texts], "value string, ts string")
    got = [r.reading_value for r in type_readings(df).collect()]
    assert got[:3] == [None] * 3 and got[3:5] == [2.0, 1000.0]
    assert math.isnan(got[5]) and got[6] == math.inf


def test_time_texts(spark):
    texts = ["2024-01-15T10:00:00+00:00", "2024-01-15T12:00:00.5+02:00", "bad", None]
    df = spark.createDataFrame([("1", t) for t in texts], "value string, ts string")
    got = [r.t for r in type_readings(df).select(
        F.col("reading_ts").cast("string").alias("t")).collect()]
    assert got == ["2024-01-15 10:00:00", "2024-01-15 10:00:00.5", None, None]


def test_passed_audit_time(spark):
    moment = datetime(2024, 1, 2, 3, 4, 5)
    df = with_ingested_at(spark.range(1), moment)
    assert df.select(F.col("_ingested_at").cast("string")).first()[0] == "2024-01-02 03:04:05"


def test_rounding_scales_first(spark):
    values = [1.005, 2.5, -2.5, 0.125, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(rules.rounded(F.col("v"), 2)).collect()]
    assert got == [1.0, 2.5, -2.5, 0.13, 0.0]


def test_month_bounds():
    assert month_bounds(date(2024, 12, 31)) == (date(2024, 12, 1), date(2025, 1, 1))
    assert month_bounds(datetime(2024, 2, 29, 23)) == (date(2024, 2, 1), date(2024, 3, 1))


def test_missing_values_have_defaults_on_dashboards(spark):
    fact = spark.sql("""
        SELECT 'r' AS reading_id, 'm' AS machine_id, 'temperature' AS sensor_type,
               cast(null AS double) AS reading_value, cast(null AS timestamp) AS reading_ts,
               cast(null AS string) AS status, 'night' AS shift, cast(null AS boolean) AS is_anomaly
    """)
    row = sensor_readings(fact, "temperature").first()
    assert (row.value, row.is_anomaly, row.threshold_status, row.ts) == (0.0, False, "NORMAL", None)
    assert live_readings(fact).first().value == 0.0
