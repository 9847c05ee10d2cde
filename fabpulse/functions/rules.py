"""Business rules on a single reading."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fabpulse.config import (
    ANOMALY_THRESHOLDS, DEVICE_ALARMS, NORMAL, REMAINING_SHIFT, SHIFT_HOURS,
)


def lookup(key: Column, mapping: Mapping[str, object]) -> Column:
    """The literal that `mapping` holds for `key`, NULL when it holds none."""
    return F.coalesce(*[F.when(key == k, F.lit(v)) for k, v in mapping.items()])


def exceeds_threshold(
    value: Column, sensor: Column, thresholds: Mapping[str, float] = ANOMALY_THRESHOLDS,
) -> Column:
    """Strictly above the sensor's threshold; FALSE for unknown sensors and NULL values."""
    return F.coalesce(value > lookup(sensor, thresholds), F.lit(False))


def shift_of(ts: Column) -> Column:
    """Shift by hour of day; readings without a timestamp count as night."""
    branches = reduce(
        lambda acc, item: acc.when(F.hour(ts).between(*item[1]), item[0]),
        SHIFT_HOURS.items(),
        F,
    )
    return branches.otherwise(REMAINING_SHIFT)


def device_status(value: Column, sensor: Column) -> Column:
    """The status a device reports for a value."""
    alarm = lookup(sensor, DEVICE_ALARMS)
    return F.when(exceeds_threshold(value, sensor), alarm).otherwise(NORMAL)


def threshold_status(value: Column, threshold: float) -> Column:
    return F.when(value > F.lit(threshold), "ABOVE_THRESHOLD").otherwise(NORMAL)


def rounded(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back, in double arithmetic.

    This is SQL ROUND on doubles as analytical databases define it. Spark's own rounds
    the shortest decimal text of the value instead, which differs on 1.005.
    """
    scale = F.lit(10.0 ** digits)
    return F.round(value.cast("double") * scale) / scale


def percent(part: Column, whole: Column, digits: int) -> Column:
    """`part` of `whole` in percent, in double arithmetic."""
    return rounded(part.cast("double") * 100.0 / whole.cast("double"), digits)


def summary_id(machine: Column, sensor: Column, hour_ts: Column) -> Column:
    return F.concat_ws("_", machine, sensor, F.date_format(hour_ts, "yyyyMMddHH"))
