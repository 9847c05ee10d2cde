"""Reading messages derived from the `events` table.

Every event becomes a message. Some carry a fault, and some are delivered twice, so that
each rule of the pipeline has something to act on at any scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.functions.rules import lookup
from fabpulse.operators.gold import fact_rows
from fabpulse.operators.silver import refine, type_readings
from fabpulse.schemas import MESSAGE
from fabpulse.sources.dimensions import seed_dimensions

SENSOR_OF_EVENT = {
    "click": "temperature", "view": "vibration", "purchase": "pressure", "signup": "power",
}
ALARM_OF_EVENT = {
    "click": ("HIGH", 90), "purchase": ("HIGH", 160), "view": ("WARN", 15), "signup": ("WARN", 60),
}


EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,"
    " props STRING"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def messages(events: DataFrame) -> DataFrame:
    """Messages as received: text fields only, with faults and second deliveries.

    `arrived` is the day of the delivery, `no_status` marks messages that lack the field.
    """
    event, kind = F.col("event_id"), F.col("event_type")
    alarm = F.coalesce(*[
        F.when((kind == k) & (F.col("value") > limit), status)
        for k, (status, limit) in ALARM_OF_EVENT.items()
    ], F.lit("NORMAL"))
    # Injected on top of all events: a second delivery with another value, a second or a day later.
    deliveries = F.when(event % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    again = F.col("late") == 1
    delay = F.when(~again, 0).when(event % 100 == 0, 86_400).otherwise(1)
    value = F.when(
        again, (F.col("value").cast("decimal(18,2)") + 1).cast("string")
    ).otherwise(F.col("value").cast("string"))
    time = F.col("ts") + F.make_dt_interval(secs=delay.cast("decimal(18,6)"))
    return events.select("*", F.explode(deliveries).alias("late")).select(
        F.when(event % 101 != 0, event.cast("string")).alias("message_id"),
        F.concat(F.lit("MACHINE_0"), (F.col("user_id") % 6 + 1).cast("string"))
        .alias("machine_id"),
        F.lit("device").alias("machine_type"),
        F.coalesce(lookup(kind, SENSOR_OF_EVENT), F.lit("humidity")).alias("sensor_type"),
        F.when(event % 97 == 0, "n/a").when(event % 131 != 0, value).alias("value"),
        F.lit("unit").alias("unit"), F.lit("Plant-A").alias("location"),
        F.when((event % 83 == 0) | (event % 113 == 0), None).when(event % 89 == 0, "NORMAL")
        .otherwise(alarm).alias("status"),
        F.lit("device").alias("shift"),
        F.when(~again & (event % 103 == 0), "not a time").when(again | (event % 107 != 0), time.cast("string"))
        .alias("ts"),
        F.lit("v1").alias("firmware_ver"),
        F.to_date(time).alias("arrived"), (event % 113 == 0).alias("no_status"), event.alias("event"),
    )


def payloads(events: DataFrame) -> DataFrame:
    """Messages as JSON text by day of arrival, with some lines that are not JSON.

    A NULL field is a JSON null, as devices send it, unless the field is missing.
    """
    fields = messages(events)
    names = [name for name in fields.columns if name in MESSAGE.fieldNames()]

    def body(columns: list[str]) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    whole = F.when(F.col("no_status"), body([n for n in names if n != "status"])).otherwise(body(names))
    broken = F.concat(F.lit("{bad "), F.col("event").cast("string"))
    lines = F.when(F.col("event") % 109 == 0, F.array(whole, broken)).otherwise(F.array(whole))
    return fields.select(F.explode(lines).alias("payload"), "arrived")


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = messages(read_events(spark, sf_dir))
    return type_readings(fields.select(*MESSAGE.fieldNames()))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine(typed(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star schema over the feed, without the calendar."""
    tables = seed_dimensions(spark)
    tables["fact_sensor_readings"] = fact_rows(
        silver(spark, sf_dir), tables["dim_machine"], tables["dim_sensor"]
    )
    return tables
