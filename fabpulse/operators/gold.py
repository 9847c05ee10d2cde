"""Silver readings to fact rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabpulse.functions.typed import audit_time


def fact_rows(
    silver: DataFrame, dim_machine: DataFrame, dim_sensor: DataFrame,
    loaded_at: datetime | None = None,
) -> DataFrame:
    """Readings of known machines and known sensors, with surrogate keys.

    No broadcast hints: Spark broadcasts a dimension while its size is below
    spark.sql.autoBroadcastJoinThreshold, and sort-merge joins a larger one, where
    adaptive execution splits a machine that holds a large share of the rows.
    """
    machines = dim_machine.select("machine_id", "machine_sk")
    sensors = dim_sensor.select("sensor_type", "sensor_sk")
    return (
        silver.join(machines, "machine_id")
        .join(sensors, "sensor_type")
        .select(
            F.col("message_id").alias("reading_id"), "machine_sk", "sensor_sk",
            "reading_value", "reading_ts", "machine_id", "sensor_type", "status",
            "shift", "is_anomaly", "_ingested_at", audit_time(loaded_at).alias("_loaded_at"),
        )
    )


def orphans(silver: DataFrame, dim_machine: DataFrame, dim_sensor: DataFrame) -> DataFrame:
    """Readings the fact load leaves out, with the dimension that lacks them."""
    machines = dim_machine.select("machine_id", F.lit(True).alias("_machine"))
    sensors = dim_sensor.select("sensor_type", F.lit(True).alias("_sensor"))
    return (
        silver.join(machines, "machine_id", "left")
        .join(sensors, "sensor_type", "left")
        .filter(F.col("_machine").isNull() | F.col("_sensor").isNull())
        .withColumns({
            "unknown_machine": F.col("_machine").isNull(),
            "unknown_sensor": F.col("_sensor").isNull(),
        })
        .drop("_machine", "_sensor")
    )
