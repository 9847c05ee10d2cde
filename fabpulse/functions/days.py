"""Date ranges as half-open timestamp predicates, which reach the Parquet scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabpulse.schemas import PARTITION_DAY


def as_date(moment: date | datetime) -> date:
    return moment.date() if isinstance(moment, datetime) else moment


def month_bounds(moment: date | datetime) -> tuple[date, date]:
    """First day of the month, and first day of the next."""
    first = as_date(moment).replace(day=1)
    return first, (first + timedelta(days=31)).replace(day=1)


def within_days(df: DataFrame, ts: str, first: date, end: date) -> DataFrame:
    """Rows with `first <= ts < end`; prunes day partitions where the table has them."""
    kept = df.filter((F.col(ts) >= _midnight(df, ts, first)) & (F.col(ts) < _midnight(df, ts, end)))
    if PARTITION_DAY in df.columns:
        day = F.col(PARTITION_DAY)
        kept = kept.filter((day >= F.lit(first)) & (day < F.lit(end)))
    return kept


def on_day(df: DataFrame, ts: str, day: date) -> DataFrame:
    return within_days(df, ts, day, day + timedelta(days=1))


def in_month_of(df: DataFrame, ts: str, as_of: date | datetime) -> DataFrame:
    return within_days(df, ts, *month_bounds(as_of))


def start_of_hour(df: DataFrame, ts: str) -> Column:
    """The hour of `ts`, in the column's own timestamp type."""
    return F.date_trunc("hour", F.col(ts)).cast(df.schema[ts].dataType)


def _midnight(df: DataFrame, ts: str, day: date) -> Column:
    return F.lit(day).cast(df.schema[ts].dataType)
