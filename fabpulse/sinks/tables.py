"""Keyed writes to Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fabpulse.layout import Layout
from fabpulse.operators.upsert import insert_or_replace, rows_to_insert
from fabpulse.schemas import PARTITION_DAY, TABLES, Table
from fabpulse.session import observing, settle
from fabpulse.sinks.files import replacing_partitions
from fabpulse.sinks.keys import held_keys
from fabpulse.sources.literal import literal_rows
from fabpulse.sources.tables import read_table


def ensure_table(spark: SparkSession, layout: Layout, name: str) -> None:
    """Create the table, empty, unless it exists."""
    empty = literal_rows(spark, [], TABLES[name].stored_schema)
    writer = empty.write.mode("ignore")
    if TABLES[name].dated_by:
        writer = writer.partitionBy(PARTITION_DAY)
    writer.parquet(layout.table(name))


def append_missing(
    spark: SparkSession, layout: Layout, name: str, source: DataFrame,
    order_by: Sequence[Column],
) -> int:
    """Insert-or-ignore into a table; returns the number of rows inserted.

    Keys are looked up wherever they are stored: of a dimension in the table itself, of a table
    partitioned by day in the index of its keys, which a small batch reads in part.
    """
    table = TABLES[name]
    rows = _with_day(table, source.select(*table.schema.fieldNames()))
    target = read_table(spark, layout, name)
    if not target.isEmpty():
        rows = settle(rows)  # read for its keys and for its rows
        if table.dated_by:
            target = held_keys(spark, layout, name, rows)
    missing = rows_to_insert(target, rows, [table.key], order_by)
    if table.dated_by is None:
        # A dimension: appending no rows would add a file.
        count = missing.count()
        if count:
            missing.write.mode("append").parquet(layout.table(name))
        return count
    inserted = Observation()
    counted = missing.observe(inserted, F.count(F.lit(1)).alias("rows"))
    with observing(spark):
        counted.hint("rebalance", PARTITION_DAY).write.mode("append") \
            .partitionBy(PARTITION_DAY).parquet(layout.table(name))
    return inserted.get["rows"]


def replace_rows(
    spark: SparkSession, layout: Layout, name: str, source: DataFrame,
    order_by: Sequence[Column],
) -> int:
    """Insert-or-replace into a table partitioned by a day that follows from the key.

    Only the days present in `source` are read and rewritten; an empty source writes
    nothing. Returns the number of source rows.
    """
    table = TABLES[name]
    rows = settle(_with_day(table, source.select(*table.schema.fieldNames())))
    count = rows.count()
    if count == 0:
        return 0
    target = read_table(spark, layout, name).filter(_in_days(_days_of(rows)))
    # Settled before the write, which replaces the very files `target` reads.
    merged = settle(insert_or_replace(target, rows, [table.key], order_by))
    replacing_partitions(merged, [PARTITION_DAY]).parquet(layout.table(name))
    return count


def _with_day(table: Table, rows: DataFrame) -> DataFrame:
    return rows.withColumn(PARTITION_DAY, F.to_date(table.dated_by)) if table.dated_by else rows


def _days_of(rows: DataFrame) -> list[date | None]:
    """The distinct days: as many as the calendar has, whatever the number of rows."""
    return [row[0] for row in rows.select(PARTITION_DAY).distinct().collect()]


def _in_days(days: list[date | None]) -> Column:
    day = F.col(PARTITION_DAY)
    dated = day.isin([d for d in days if d is not None])
    return dated | day.isNull() if None in days else dated
