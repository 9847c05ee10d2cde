"""Parquet layers: Silver and the Gold tables."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from fabpulse.layout import Layout
from fabpulse.schemas import SILVER, TABLES
from fabpulse.sources.bronze import arrival_date
from fabpulse.sources.literal import literal_rows


def read_silver(
    spark: SparkSession, root: str, partitions: Iterable[date] | None = None,
) -> DataFrame:
    silver = spark.read.schema(SILVER).parquet(root)
    return silver if partitions is None else silver.filter(arrival_date().isin(list(partitions)))


def table_or_none(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    try:
        return spark.read.schema(TABLES[name].stored_schema).parquet(layout.table(name))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The table with its declared schema; empty while nothing has been written."""
    table = table_or_none(spark, layout, name)
    return literal_rows(spark, [], TABLES[name].stored_schema) if table is None else table
