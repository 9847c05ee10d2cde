from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from helpers import rows
from fabpulse.operators.dedup import first_per_key
from fabpulse.operators.upsert import insert_or_ignore, insert_or_replace, rows_to_insert
from fabpulse.schemas import TABLES
from fabpulse.sinks.tables import append_missing, ensure_table, replace_rows
from fabpulse.sources.tables import read_table, table_or_none

SCHEMA = "k string, v int"


def order():
    return [F.col("v")]


def test_existing_rows_win_and_the_first_of_a_batch(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([("a", 9), ("b", 5), ("b", 4), ("c", 7)], SCHEMA)
    assert rows(rows_to_insert(target, source, ["k"], order()), "k", "v") == [("b", 4), ("c", 7)]
    assert rows(insert_or_ignore(target, source, ["k"], order()), "k", "v") == [
        ("a", 1), ("b", 4), ("c", 7)]


def test_source_rows_replace(spark):
    target = spark.createDataFrame([("a", 1), ("z", 2)], SCHEMA)
    source = spark.createDataFrame([("a", 9), ("b", 5)], SCHEMA)
    assert rows(insert_or_replace(target, source, ["k"], order()), "k", "v") == [
        ("a", 9), ("b", 5), ("z", 2)]


def test_null_key_is_an_error(spark):
    target = spark.createDataFrame([], SCHEMA)
    source = spark.createDataFrame([(None, 1)], SCHEMA)
    with pytest.raises(PySparkException, match="NULL in key column k"):
        insert_or_ignore(target, source, ["k"], order()).collect()


def test_a_key_with_most_rows_is_limited_before_the_shuffle(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, 'hot', cast(id AS string)) AS k", "id AS v")
    first = first_per_key(df, ["k"], [F.col("v")])
    plan = first._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial") > plan.index("hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and partial
    assert first.count() == 66_667 and first.filter("k = 'hot'").first().v == 0


def summary(spark, *items):
    """(id, hour text, count)"""
    return spark.createDataFrame(
        [(i, "m", "temperature", h, 1.0, 1.0, 1.0, 0, n) for i, h, n in items],
        "summary_id string, machine_id string, sensor_type string, hour_ts string,"
        " avg_value double, min_value double, max_value double, anomaly_count int,"
        " reading_count int",
    ).withColumn("hour_ts", F.col("hour_ts").cast("timestamp"))


def files_of(spark, lake, name, day):
    stored = read_table(spark, lake, name).filter(F.col("partition_day") == F.lit(day))
    return rows(stored.select("_metadata.file_path").distinct(), "file_path")


def test_replacing_rewrites_only_the_days_present(spark, lake):
    name, by = "hourly_machine_summary", [F.col("reading_count")]
    stored = summary(spark, ("a", "2024-01-01 01:00:00", 1), ("b", "2024-01-01 02:00:00", 2),
                     ("c", "2024-01-02 01:00:00", 3))
    assert replace_rows(spark, lake, name, stored, by) == 3
    files = files_of(spark, lake, name, date(2024, 1, 2))
    assert replace_rows(spark, lake, name, summary(spark, ("a", "2024-01-01 01:00:00", 9)), by) == 1
    table = read_table(spark, lake, name)
    assert rows(table, "summary_id", "reading_count") == [("a", 9), ("b", 2), ("c", 3)]
    assert files_of(spark, lake, name, date(2024, 1, 2)) == files


def test_replacing_with_nothing_writes_nothing(spark, lake):
    name = "hourly_machine_summary"
    assert replace_rows(spark, lake, name, summary(spark, ("a", "2024-01-01 01:00:00", 1)).limit(0),
                        [F.col("hour_ts")]) == 0
    assert table_or_none(spark, lake, name) is None


def test_tables_exist_once(spark, lake):
    assert read_table(spark, lake, "anomaly_log").count() == 0
    for _ in range(2):
        ensure_table(spark, lake, "anomaly_log")
    assert table_or_none(spark, lake, "anomaly_log").count() == 0
    assert read_table(spark, lake, "anomaly_log").schema == TABLES["anomaly_log"].stored_schema


def log_rows(spark, *items):
    return spark.createDataFrame(
        [(i, "m", "temperature", v, "HIGH", t, None) for i, t, v in items],
        "reading_id string, machine_id string, sensor_type string, reading_value double,"
        " status string, reading_ts string, captured_at timestamp",
    ).withColumn("reading_ts", F.col("reading_ts").cast("timestamp"))


def test_appending_counts_and_ignores_known_keys_on_any_day(spark, lake):
    by = [F.col("reading_ts").asc_nulls_last()]
    first = log_rows(spark, ("a", "2024-01-01 10:00:00", 1.0), ("b", None, 2.0))
    assert append_missing(spark, lake, "anomaly_log", first, by) == 2
    again = log_rows(spark, ("a", "2024-03-01 10:00:00", 9.0), ("b", None, 9.0),
                     ("c", "2024-01-01 11:00:00", 3.0))
    assert append_missing(spark, lake, "anomaly_log", again, by) == 1
    assert append_missing(spark, lake, "anomaly_log", again, by) == 0
    assert rows(read_table(spark, lake, "anomaly_log"), "reading_id", "reading_value") == [
        ("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_only_known_keys_of_the_batch_reach_the_second_join(spark, lake):
    by = [F.col("reading_ts").asc_nulls_last()]
    many = log_rows(spark, *((f"r{i}", "2024-01-01 10:00:00", 1.0) for i in range(50)))
    assert append_missing(spark, lake, "anomaly_log", many, by) == 50
    late = log_rows(spark, ("r7", "2024-06-01 10:00:00", 2.0), ("new", "2024-06-01 10:00:00", 2.0))
    assert append_missing(spark, lake, "anomaly_log", late, by) == 1
    assert read_table(spark, lake, "anomaly_log").groupBy("reading_id").count().where(
        "count > 1").count() == 0
