"""The registered queries: every operator over the whole feed."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import feed
from fabpulse.config import ANOMALY_THRESHOLDS
from fabpulse.functions.days import within_days
from fabpulse.functions.rules import device_status, rounded
from fabpulse.layout import Layout
from fabpulse.operators import business, checks, rolling
from fabpulse.operators.gold import fact_rows, orphans
from fabpulse.operators.governance import open_as, role_query, role_views
from fabpulse.operators.rollup import hourly_rollup
from fabpulse.operators.silver import split_quarantine, with_is_anomaly, with_shift
from fabpulse.operators.upsert import insert_or_ignore, insert_or_replace
from fabpulse.plans.batch import run_batch
from fabpulse.plans.dashboards import build_dashboards, datasets
from fabpulse.plans.gold import build_gold
from fabpulse.plans.hourly import run_hourly
from fabpulse.plans.reports import run_business_queries
from fabpulse.plans.rolling import refresh_rolling_average
from fabpulse.plans.silver import build_silver
from fabpulse.plans.totals import refresh_day_totals
from fabpulse.schemas import ARRIVAL_COLUMNS, BRONZE, MESSAGE, PARTITION_DAY
from fabpulse.session import own_session, scratch_folder
from fabpulse.sinks.keys import held_keys, open_index
from fabpulse.sources.bronze import read_bronze
from fabpulse.sources.dimensions import dim_date, seed_dimensions
from fabpulse.sources.literal import literal_rows
from fabpulse.sources.tables import read_silver, read_table
from fabpulse.streaming.anomalies import capture_anomalies
from fabpulse.streaming.landing import write_bronze_stream
from fabpulse.streaming.source import admission, read_reading_stream

Query = Callable[[SparkSession, str], DataFrame]

DAY = date(2024, 1, 15)
UPTIME_INTERVAL_S = 3600
FIELDS = ["message_id", "machine_id", "sensor_type", "value", "status", "ts"]
SILVER_FIELDS = ["message_id", "machine_id", "sensor_type", "status", "reading_value", "reading_ts",
                 "is_anomaly", "shift"]
AUDIT = ["_ingested_at", "_loaded_at", PARTITION_DAY]

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query; timestamps leave without a zone, audit columns not at all."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(own_session(spark), sf_dir).drop(*AUDIT)
        zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})

    QUERIES[build.__name__] = run
    return build


def new_lake(spark: SparkSession) -> Layout:
    """A lake of its own, in the folder all executors share."""
    return Layout(scratch_folder(spark, "lake"))


def landed(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake whose Bronze holds the feed, as if each message had arrived on its day."""
    lake = new_lake(spark)
    land(feed.payloads(feed.read_events(spark, sf_dir)), lake)
    return lake


def land(lines: DataFrame, lake: Layout) -> None:
    patterns = zip(ARRIVAL_COLUMNS, ("yyyy", "MM", "dd"), strict=True)
    lines.select(
        F.col("payload").alias("value"),
        *[F.date_format("arrived", p).alias(c) for c, p in patterns],
    ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*ARRIVAL_COLUMNS).text(lake.bronze)


def topic(spark: SparkSession, sf_dir: str) -> str:
    """The feed as a folder of message texts."""
    folder = scratch_folder(spark, "topic")
    feed.payloads(feed.read_events(spark, sf_dir)).select("payload").write.mode("overwrite").text(folder)
    return folder


# --- Bronze and Silver ---------------------------------------------------------------


@query
def bronze_scan(spark, sf_dir):
    return read_bronze(spark, landed(spark, sf_dir).bronze).select(*FIELDS)


@query
def bronze_scan_one_day(spark, sf_dir):
    return read_bronze(spark, landed(spark, sf_dir).bronze, [DAY]).select(*FIELDS)


@query
def typed_readings(spark, sf_dir):
    return feed.typed(spark, sf_dir).select("message_id", "reading_value", "reading_ts")


@query
def quarantine(spark, sf_dir):
    return split_quarantine(feed.typed(spark, sf_dir))[1].select(*FIELDS)


@query
def silver_readings(spark, sf_dir):
    return feed.silver(spark, sf_dir).select(*SILVER_FIELDS)


@query
def run_metrics(spark, sf_dir):
    """The numbers that the Silver job reports."""
    metrics = build_silver(spark, landed(spark, sf_dir))
    return literal_rows(spark, [tuple(metrics.values())], T.StructType([
        T.StructField(name, T.LongType()) for name in metrics]))


@query
def silver_files(spark, sf_dir):
    """Silver as stored, after one run over all days and another."""
    lake = landed(spark, sf_dir)
    for _ in range(2):
        build_silver(spark, lake)
    return read_silver(spark, lake.silver).select(*SILVER_FIELDS)


@query
def silver_incremental(spark, sf_dir):
    """Silver as stored after runs over some days at a time, the latest first."""
    lake = landed(spark, sf_dir)
    days = [r[0] for r in feed.payloads(feed.read_events(spark, sf_dir)).select("arrived").distinct().collect()]
    for rest in (2, 1, 0):
        build_silver(spark, lake, [day for day in days if day.day % 3 == rest])
    return read_silver(spark, lake.silver).select(*SILVER_FIELDS)


@query
def quarantine_files(spark, sf_dir):
    """The quarantine as stored after all lines of some days were bad, and then corrected."""
    lake = new_lake(spark)
    lines = feed.payloads(feed.read_events(spark, sf_dir))
    spoiled = F.when(F.dayofmonth("arrived") % 10 == 5, F.lit("{spoiled")).otherwise(F.col("payload"))
    land(lines.withColumn("payload", spoiled), lake)
    build_silver(spark, lake)
    land(lines, lake)
    build_silver(spark, lake)
    return spark.read.schema(BRONZE).json(lake.quarantine).select(*FIELDS)


@query
def anomaly_flags(spark, sf_dir):
    flagged = with_is_anomaly(split_quarantine(feed.typed(spark, sf_dir))[0])
    return flagged.groupBy("sensor_type").agg(
        F.count_if("is_anomaly").alias("anomalies"), F.count(F.lit(1)).alias("readings")
    )


@query
def shift_of_reading(spark, sf_dir):
    shifted = with_shift(split_quarantine(feed.typed(spark, sf_dir))[0])
    return shifted.groupBy("shift").agg(F.count(F.lit(1)).alias("readings"))


@query
def device_status_of_reading(spark, sf_dir):
    good, _ = split_quarantine(feed.typed(spark, sf_dir))
    status = device_status(F.col("reading_value"), F.col("sensor_type"))
    return good.select("message_id", "reading_ts", status.alias("device_status"))


# --- Dimensions: every row, with the number of readings it describes ------------------


def _described(spark, sf_dir, dimension: DataFrame, key: str, reading_key) -> DataFrame:
    counts = (
        feed.silver(spark, sf_dir).groupBy(reading_key.alias(key))
        .agg(F.count(F.lit(1)).alias("readings"))
    )
    return dimension.join(counts, key, "left").fillna(0, ["readings"])


@query
def dim_machine_readings(spark, sf_dir):
    machines = seed_dimensions(spark)["dim_machine"]
    return _described(spark, sf_dir, machines, "machine_id", F.col("machine_id"))


@query
def dim_sensor_readings(spark, sf_dir):
    sensors = seed_dimensions(spark)["dim_sensor"]
    return _described(spark, sf_dir, sensors, "sensor_type", F.col("sensor_type"))


@query
def dim_location_readings(spark, sf_dir):
    seeds = seed_dimensions(spark)
    plants = seeds["dim_machine"].select("machine_id", F.col("plant").alias("location_id"))
    counts = (
        feed.silver(spark, sf_dir).join(plants, "machine_id").groupBy("location_id")
        .agg(F.count(F.lit(1)).alias("readings"))
    )
    return seeds["dim_location"].join(counts, "location_id", "left").fillna(0, ["readings"])


@query
def dim_date_readings(spark, sf_dir):
    return _described(spark, sf_dir, dim_date(spark), "full_date", F.to_date("reading_ts"))


# --- Gold ----------------------------------------------------------------------------


@query
def gold_fact(spark, sf_dir):
    return feed.gold(spark, sf_dir)["fact_sensor_readings"]


@query
def gold_orphans(spark, sf_dir):
    seeds = seed_dimensions(spark)
    rows = orphans(feed.silver(spark, sf_dir), seeds["dim_machine"], seeds["dim_sensor"])
    return rows.select(
        "message_id", "machine_id", "sensor_type", "unknown_machine", "unknown_sensor"
    )


@query
def constraint_violations(spark, sf_dir):
    """A fact table with repeated and missing keys, and dimensions with lost, repeated and empty rows."""
    seeds = seed_dimensions(spark)
    machines, sensors = seeds["dim_machine"], seeds["dim_sensor"]
    valued = feed.typed(spark, sf_dir).filter("reading_value IS NOT NULL")
    raw_fact = fact_rows(with_shift(with_is_anomaly(valued)), machines, sensors)
    nameless = F.when(F.col("machine_sk") != 3, F.col("machine_id"))
    return checks.constraint_violations({
        "dim_machine": machines.filter("machine_sk <> 5").withColumn("machine_id", nameless)
        .union(machines.filter("machine_sk = 1")),
        "dim_sensor": sensors.union(
            sensors.filter("sensor_sk = 4").withColumn("sensor_sk", F.lit(None).cast("int"))),
        "fact_sensor_readings": raw_fact,
    })


@query
def upsert_ignore(spark, sf_dir):
    """Half of the month is loaded, with values of its own; then everything is inserted."""
    good, _ = split_quarantine(feed.typed(spark, sf_dir))
    seeds = seed_dimensions(spark)
    every_delivery = fact_rows(
        with_shift(with_is_anomaly(good)), seeds["dim_machine"], seeds["dim_sensor"]
    )
    fact = feed.gold(spark, sf_dir)["fact_sensor_readings"]
    loaded = within_days(fact, "reading_ts", date(2024, 1, 1), date(2024, 1, 16)).withColumn(
        "reading_value", F.lit(-1.0)
    )
    return insert_or_ignore(
        loaded, every_delivery, ["reading_id"], [F.col("reading_ts").asc_nulls_last()]
    ).select(
        "reading_id", "machine_sk", "sensor_sk", "reading_value", "reading_ts"
    )


@query
def upsert_replace(spark, sf_dir):
    """All hourly summaries, of which the second half of the month is summarised anew."""
    tables = feed.gold(spark, sf_dir)
    summary = hourly_rollup(tables["fact_sensor_readings"], tables["dim_sensor"])
    fresh = within_days(summary, "hour_ts", date(2024, 1, 16), date(2024, 2, 1)).withColumn(
        "reading_count", F.lit(0)
    )
    return _rounded(insert_or_replace(summary, fresh, ["summary_id"], [F.col("hour_ts")]))


# --- Business queries ----------------------------------------------------------------


@query
def bq01_hot_machines(spark, sf_dir):
    tables = feed.gold(spark, sf_dir)
    return business.hot_machines(tables["fact_sensor_readings"], tables["dim_sensor"])


@query
def bq02_uptime(spark, sf_dir):
    fact = feed.gold(spark, sf_dir)["fact_sensor_readings"]
    return business.uptime(fact, DAY, UPTIME_INTERVAL_S)


@query
def bq03_shift_anomaly_rate(spark, sf_dir):
    return business.shift_anomaly_rate(feed.gold(spark, sf_dir)["fact_sensor_readings"])


@query
def bq04_rolling_avg(spark, sf_dir):
    tables = feed.gold(spark, sf_dir)
    return _eight_digits(
        rolling.rolling_avg_readings(tables["fact_sensor_readings"], tables["dim_sensor"]),
        "rolling_avg_7d",
    )


@query
def bq04_rolling_avg_daily(spark, sf_dir):
    tables = feed.gold(spark, sf_dir)
    return _eight_digits(
        rolling.rolling_avg_days(tables["fact_sensor_readings"], tables["dim_sensor"]),
        "daily_avg", "rolling_avg_7d",
    )


@query
def rolling_refreshed(spark, sf_dir):
    """The rolling average as stored, refreshed after each of three loads that share their days."""
    lake = landed(spark, sf_dir)
    build_silver(spark, lake)
    days = [r[0] for r in feed.payloads(feed.read_events(spark, sf_dir)).select("arrived").distinct().collect()]
    for rest in (2, 0, 1):
        build_gold(spark, lake, [day for day in days if day.day % 3 == rest])
        refreshed = refresh_rolling_average(spark, lake)
    return _eight_digits(refreshed.averages, "rolling_avg_7d")


def _eight_digits(df: DataFrame, *columns: str) -> DataFrame:
    """Engines add up in different orders, so averages differ in the last bits."""
    return df.withColumns({c: rounded(F.col(c), 8) for c in columns})


def _rounded(summary: DataFrame) -> DataFrame:
    return _eight_digits(summary, "avg_value")


# --- Rollup and dashboards -----------------------------------------------------------


@query
def hourly_summary(spark, sf_dir):
    tables = feed.gold(spark, sf_dir)
    return _rounded(hourly_rollup(tables["fact_sensor_readings"], tables["dim_sensor"]))


@query
def hourly_summary_one_day(spark, sf_dir):
    tables = feed.gold(spark, sf_dir)
    return _rounded(hourly_rollup(tables["fact_sensor_readings"], tables["dim_sensor"], DAY))


def _dashboard(name: str) -> None:
    def build(spark, sf_dir):
        return datasets(feed.gold(spark, sf_dir)["fact_sensor_readings"])[name]

    build.__name__ = f"dash_{name}"
    query(build)


for _name in (*ANOMALY_THRESHOLDS, "live_readings", "anomalies", "machine_summary", "anomaly_rate"):
    _dashboard(_name)


@query
def dash_export_stats(spark, sf_dir):
    """The numbers that the dashboard job reports."""
    stats = build_dashboards(spark, stored_gold(spark, sf_dir))
    rows = [(name, *counts.values()) for name, counts in stats.items()]
    return _or_na(literal_rows(spark, rows, T.StructType([
        T.StructField("dataset", T.StringType()), T.StructField("row_count", T.LongType()),
        T.StructField("anomaly_rows", T.LongType())])), "anomaly_rows")


@query
def dash_stored(spark, sf_dir):
    """A listing as the job wrote it."""
    lake = stored_gold(spark, sf_dir)
    build_dashboards(spark, lake)
    return spark.read.schema(
        "machine STRING, sensor STRING, value DOUBLE, ts STRING, status STRING, shift STRING,"
        " is_anomaly BOOLEAN").json(f"{lake.dashboards}/live_readings")


@query
def dash_refreshed(spark, sf_dir):
    """An aggregate as the job wrote it after three loads, the day totals refreshed after each."""
    lake = landed(spark, sf_dir)
    days = [r[0] for r in feed.payloads(feed.read_events(spark, sf_dir)).select("arrived").distinct().collect()]
    build_silver(spark, lake)
    for rest in range(3):
        build_gold(spark, lake, [day for day in days if day.day % 3 == rest])
        refresh_day_totals(spark, lake)
    build_dashboards(spark, lake)
    return spark.read.schema(
        "machine STRING, sensor STRING, avg_value DOUBLE, max_value DOUBLE, min_value DOUBLE,"
        " total_readings BIGINT, anomaly_count BIGINT, anomaly_pct DOUBLE").json(f"{lake.dashboards}/machine_summary")


def stored_gold(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake that holds Silver and Gold of the feed."""
    lake = landed(spark, sf_dir)
    build_silver(spark, lake)
    build_gold(spark, lake)
    return lake


@query
def hourly_stored(spark, sf_dir):
    """The stored summaries of a day, after two runs."""
    lake = stored_gold(spark, sf_dir)
    for _ in range(2):
        run_hourly(spark, lake, DAY)
    return _rounded(read_table(spark, lake, "hourly_machine_summary"))


@query
def report_stored(spark, sf_dir):
    """A report as the job wrote it."""
    lake = stored_gold(spark, sf_dir)
    tables = {name: read_table(spark, lake, name) for name in ("fact_sensor_readings", "dim_sensor")}
    outcome = run_business_queries(tables, DAY, f"{lake.root}/reports", ["hot_machines"])["hot_machines"]
    if outcome.error:
        raise RuntimeError(outcome.error)
    return outcome.read(spark)


def _or_na(df: DataFrame, column: str) -> DataFrame:
    """The column as text, with n/a for NULL."""
    return df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit("n/a")))


# --- Counts, roles -------------------------------------------------------------------


@query
def table_row_counts(spark, sf_dir):
    tables = feed.gold(spark, sf_dir)
    summary = hourly_rollup(tables["fact_sensor_readings"], tables["dim_sensor"])
    counts = checks.table_row_counts(spark, {
        "bronze": feed.messages(feed.read_events(spark, sf_dir)),
        "silver": feed.silver(spark, sf_dir),
        **tables,
        "dim_date": dim_date(spark),
        "hourly_machine_summary": summary,
        "anomaly_log": None,
    })
    return _or_na(counts, "row_count")


def _loaders(sf_dir: str):
    def summary(spark):
        tables = feed.gold(spark, sf_dir)
        return hourly_rollup(tables["fact_sensor_readings"], tables["dim_sensor"])

    names = ("fact_sensor_readings", "dim_machine", "dim_sensor", "dim_location")
    return {
        **{name: lambda spark, name=name: feed.gold(spark, sf_dir)[name] for name in names},
        "dim_date": dim_date,
        "hourly_machine_summary": summary,
    }


@query
def role_engineer_counts(spark, sf_dir):
    session = role_views(spark, "engineer", _loaders(sf_dir))
    return role_query(
        session, "engineer",
        "SELECT machine_id, COUNT(*) AS n FROM fact_sensor_readings GROUP BY 1",
    )


@query
def role_analyst_fact(spark, sf_dir):
    session = role_views(spark, "analyst", _loaders(sf_dir))
    return role_query(session, "analyst", "SELECT * FROM fact_sensor_readings")


@query
def role_viewer_summary(spark, sf_dir):
    session = role_views(spark, "viewer", _loaders(sf_dir))
    return role_query(
        session, "viewer",
        "SELECT machine_id, ROUND(AVG(avg_value), 8) AS mean_value"
        " FROM hourly_machine_summary GROUP BY 1",
    )


@query
def role_over_lake(spark, sf_dir):
    session = open_as(spark, "engineer", stored_gold(spark, sf_dir))
    return role_query(
        session, "engineer",
        "SELECT machine_id, COUNT(*) AS n FROM fact_sensor_readings GROUP BY 1",
    )


@query
def role_sample(spark, sf_dir):
    """Some rows, which ones is not defined: how many they are, and how many of them the table holds."""
    session = open_as(spark, "analyst", stored_gold(spark, sf_dir))
    return role_query(
        session, "analyst",
        "WITH sample AS (SELECT * FROM fact_sensor_readings LIMIT 3)"
        " SELECT COUNT(*) AS sampled, COUNT(f.reading_id) AS known FROM sample LEFT JOIN fact_sensor_readings AS f"
        " ON f.reading_id = sample.reading_id AND f.reading_value = sample.reading_value")


# --- Whole runs on files and streams --------------------------------------------------


@query
def batch_fact(spark, sf_dir):
    """A batch cycle over landed files, and a second load, which must change nothing."""
    lake = landed(spark, sf_dir)
    report = run_batch(spark, lake, target_date=DAY)
    if report["errors"]:
        raise RuntimeError(str(report["errors"]))
    build_gold(spark, lake)
    return read_table(spark, lake, "fact_sensor_readings")


@query
def stream_bronze(spark, sf_dir):
    lake = new_lake(spark)
    messages = read_reading_stream(spark, topic(spark, sf_dir))
    write_bronze_stream(messages, lake, availableNow=True).awaitTermination()
    return read_bronze(spark, lake.bronze).select(*FIELDS)


def _captured(spark, sf_dir) -> Layout:
    lake = new_lake(spark)
    messages = read_reading_stream(spark, topic(spark, sf_dir))
    capture_anomalies(messages, lake, availableNow=True).awaitTermination()
    return lake


CAPTURED = ["reading_id", "machine_id", "sensor_type", "reading_value", "status", "reading_ts"]


@query
def stream_anomalies(spark, sf_dir):
    return read_table(spark, _captured(spark, sf_dir), "anomaly_log").select(*CAPTURED)


class SecondStream(Layout):
    """The same lake, for a stream that starts with a checkpoint folder of its own."""

    def checkpoint(self, stream: str) -> str:
        return f"{self.root}/checkpoints/second-{stream}"


@query
def stream_restart(spark, sf_dir):
    """The log after all messages came again, a day later, to a stream that knows of nothing."""
    lake = SecondStream(_captured(spark, sf_dir).root)
    day_later = F.regexp_replace("payload", r'"ts":"2024-01-', '"ts":"2024-02-').alias("payload")
    again = read_reading_stream(spark, topic(spark, sf_dir)).select(day_later)
    capture_anomalies(again, lake, availableNow=True).awaitTermination()
    return read_table(spark, lake, "anomaly_log").select(*CAPTURED)


@query
def stream_in_batches(spark, sf_dir):
    """The log, of a stream that takes one file at a time: later deliveries of an id come in later micro-batches."""
    lake = new_lake(spark)
    folder = scratch_folder(spark, "topic")
    lines = feed.payloads(feed.read_events(spark, sf_dir))
    lines.repartitionByRange(6, "arrived").sortWithinPartitions("arrived").select("payload") \
        .write.mode("overwrite").text(folder)
    messages = read_reading_stream(spark, folder, **admission("text", files=1))
    stream = capture_anomalies(messages, lake, availableNow=True)
    stream.awaitTermination()
    if sum(p["numInputRows"] > 0 for p in stream.recentProgress) < 2:
        raise RuntimeError("the stream took everything at once")
    return read_table(spark, lake, "anomaly_log").select("reading_id", "machine_id", "sensor_type", "status")


@query
def anomaly_keys(spark, sf_dir):
    """What the log's key index tells of all messages, after it took in the files of a captured stream."""
    lake = _captured(spark, sf_dir)
    open_index(spark, lake, "anomaly_log", fresh_files=0)
    asked = feed.messages(feed.read_events(spark, sf_dir)).select(F.col("message_id").alias("reading_id"))
    held = held_keys(spark, lake, "anomaly_log", asked).distinct()
    return asked.distinct().filter("reading_id IS NOT NULL").join(
        held.withColumn("held", F.lit(True)), "reading_id", "left").fillna(False, ["held"])


@query
def stream_dead_letters(spark, sf_dir):
    letters = spark.read.schema("error STRING, payload STRING").json(
        _captured(spark, sf_dir).dead_letters
    )
    return letters.select(
        F.from_json("payload", MESSAGE)["message_id"].alias("message_id"), "error"
    )
