"""Declared schemas. Nothing in this package infers a schema."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# A reading message as published: every field is text, `value` included.
MESSAGE = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "message_id", "machine_id", "machine_type", "sensor_type", "value", "unit",
        "location", "status", "shift", "ts", "firmware_ver",
    )
])

# Where a message landed, by UTC arrival day.
ARRIVAL = T.StructType([
    T.StructField(name, T.IntegerType()) for name in ("year", "month", "day")
])
ARRIVAL_COLUMNS = tuple(ARRIVAL.fieldNames())

CORRUPT_RECORD = "_corrupt_record"
BRONZE = T.StructType([
    *MESSAGE.fields, T.StructField(CORRUPT_RECORD, T.StringType()), *ARRIVAL.fields,
])

SILVER = T.StructType([
    *MESSAGE.fields,
    T.StructField("reading_value", T.DoubleType()),
    T.StructField("reading_ts", T.TimestampType()),
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("is_anomaly", T.BooleanType()),
    *ARRIVAL.fields,
])

# One delivery of each message for every day it arrived on. Of a message's deliveries one is the `first`: Silver.
PLACE, FIRST, LATER = "place", "first", "later"
DELIVERIES = T.StructType([*SILVER.fields, T.StructField(PLACE, T.StringType())])


INT, TEXT, NUMBER = T.IntegerType(), T.StringType(), T.DoubleType()
FLAG, DAY, TIME = T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


@dataclass(frozen=True)
class Table:
    """A Parquet table: its columns, its rules and how it is laid out.

    `dated_by` names the timestamp column whose UTC day partitions the table; the
    day is stored as the partition column `partition_day`.
    """

    name: str
    schema: T.StructType
    key: str
    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    dated_by: str | None = None

    @property
    def stored_schema(self) -> T.StructType:
        if self.dated_by is None:
            return self.schema
        return T.StructType([*self.schema.fields, T.StructField(PARTITION_DAY, T.DateType())])


PARTITION_DAY = "partition_day"
KEY_BUCKET = "key_bucket"

TABLES = {
    table.name: table
    for table in (
        Table(
            "dim_machine",
            _struct(
                machine_sk=INT, machine_id=TEXT, machine_type=TEXT, plant=TEXT, status=TEXT,
            ),
            key="machine_sk", unique=("machine_id",),
        ),
        Table(
            "dim_sensor",
            _struct(
                sensor_sk=INT, sensor_type=TEXT, unit=TEXT, anomaly_threshold=NUMBER,
            ),
            key="sensor_sk", unique=("sensor_type",),
        ),
        Table(
            "dim_location",
            _struct(
                location_sk=INT, location_id=TEXT, plant_name=TEXT, city=TEXT, state=TEXT,
            ),
            key="location_sk", unique=("location_id",),
        ),
        Table(
            "dim_date",
            _struct(
                date_sk=INT, full_date=DAY, year=INT, month=INT, day=INT, day_of_week=INT,
                is_weekend=FLAG,
            ),
            key="date_sk", unique=("full_date",),
        ),
        Table(
            "fact_sensor_readings",
            _struct(
                reading_id=TEXT, machine_sk=INT, sensor_sk=INT, reading_value=NUMBER,
                reading_ts=TIME, machine_id=TEXT, sensor_type=TEXT, status=TEXT, shift=TEXT,
                is_anomaly=FLAG, _ingested_at=TIME, _loaded_at=TIME,
            ),
            key="reading_id", dated_by="reading_ts",
            references={
                "machine_sk": ("dim_machine", "machine_sk"),
                "sensor_sk": ("dim_sensor", "sensor_sk"),
            },
        ),
        Table(
            "hourly_machine_summary",
            _struct(
                summary_id=TEXT, machine_id=TEXT, sensor_type=TEXT, hour_ts=TIME, avg_value=NUMBER,
                min_value=NUMBER, max_value=NUMBER, anomaly_count=INT, reading_count=INT,
            ),
            key="summary_id", dated_by="hour_ts",
        ),
        Table(
            "anomaly_log",
            _struct(
                reading_id=TEXT, machine_id=TEXT, sensor_type=TEXT, reading_value=NUMBER,
                status=TEXT, reading_ts=TIME, captured_at=TIME,
            ),
            key="reading_id", dated_by="reading_ts",
        ),
    )
}

# Stored totals of the fact table, partitioned by day.
DAY_TOTALS = _struct(
    machine=TEXT, sensor=TEXT, value_sum=NUMBER, value_count=T.LongType(), max_value=NUMBER, min_value=NUMBER,
    total_readings=T.LongType(), anomaly_count=T.LongType(), day=DAY,
)

# Stored rolling averages, and each day's last readings; both partitioned by day.
ROLLING = _struct(
    machine_id=TEXT, reading_date=DAY, reading_id=TEXT, rolling_avg_7d=NUMBER, partition_day=DAY)
LAST_READINGS = _struct(
    machine_id=TEXT, reading_id=TEXT, reading_value=NUMBER, reading_date=DAY, _us=T.LongType(), partition_day=DAY)
