"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fabpulse.session import scratch_folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    return f"{scratch_folder(spark, 'llm')}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
