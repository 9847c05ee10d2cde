"""Landed messages: JSON lines below year=/month=/day= of arrival."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabpulse.schemas import ARRIVAL_COLUMNS, BRONZE, CORRUPT_RECORD


def arrival_date() -> Column:
    return F.make_date(*ARRIVAL_COLUMNS)


def read_bronze(
    spark: SparkSession, root: str, partitions: Iterable[date] | None = None,
) -> DataFrame:
    """Messages of all arrival days, or of the given ones only.

    A malformed line becomes a row of NULLs that keeps its text in `_corrupt_record`.
    """
    lines = (
        spark.read.schema(BRONZE)
        .option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        .json(root)
    )
    if partitions is None:
        return lines
    return lines.filter(arrival_date().isin(list(partitions)))


def has_input(spark: SparkSession, root: str) -> bool:
    """Whether anything has landed yet."""
    try:
        return not read_bronze(spark, root).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
