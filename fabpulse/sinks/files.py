"""Silver, quarantine and dashboard files."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from fabpulse.schemas import ARRIVAL_COLUMNS, FIRST, PLACE
from fabpulse.session import file_system


def replacing_partitions(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrameWriter:
    """A writer that replaces the partitions present in `df` and leaves all others.

    Rows are first rebalanced: adaptive execution cuts them into files of the advisory
    size, however large or small a partition is.
    """
    return (
        df.hint("rebalance", *columns).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
    )


def replacing_all(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrameWriter:
    """A writer that replaces everything, so that a partition without rows is gone."""
    return replacing_partitions(df, columns).option("partitionOverwriteMode", "static")


def drop_days(spark: SparkSession, root: str, days: Iterable[date]) -> None:
    """Remove arrival days, those that exist."""
    for day in days:
        for month, number in ((f"{day.month:02}", f"{day.day:02}"), (day.month, day.day)):
            path, files = file_system(spark, f"{root}/year={day.year}/month={month}/day={number}")
            files.delete(path, True)


def write_deliveries(df: DataFrame, root: str, days: list[date] | None = None) -> None:
    """Replace all deliveries, or the partitions present in `df` when `days` are given.

    Silver and the deliveries behind it are partitions of one table, so both change in one commit. Those of
    `days` that `df` doesn't hold have to be dropped by the caller, see `drop_days`.
    """
    replace = replacing_all if days is None else replacing_partitions
    replace(df, (PLACE, *ARRIVAL_COLUMNS)).parquet(root)
    path, files = file_system(df.sparkSession, f"{root}/{PLACE}={FIRST}")
    files.mkdirs(path)  # Silver exists, without rows too


def write_quarantine(bad: DataFrame, root: str, days: list[date] | None = None) -> None:
    """Replace all rejected messages, or the partitions present in `bad` when `days` are given."""
    replace = replacing_all if days is None else replacing_partitions
    replace(bad, ARRIVAL_COLUMNS).json(root)


def write_dashboard(df: DataFrame, root: str, name: str) -> None:
    """JSON lines that keep NULL fields."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/{name}")
