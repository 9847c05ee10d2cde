"""The business queries by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from fabpulse.operators.business import hot_machines, shift_anomaly_rate, uptime
from fabpulse.operators.rolling import rolling_avg_days, rolling_avg_readings

Tables = Mapping[str, DataFrame]
Report = Callable[[Tables, date], DataFrame]

REPORTS: dict[str, Report] = {
    "hot_machines": lambda t, _: hot_machines(t["fact_sensor_readings"], t["dim_sensor"]),
    "uptime": lambda t, as_of: uptime(t["fact_sensor_readings"], as_of),
    "shift_anomaly_rate": lambda t, _: shift_anomaly_rate(t["fact_sensor_readings"]),
    "rolling_avg_readings":
        lambda t, _: rolling_avg_readings(t["fact_sensor_readings"], t["dim_sensor"]),
    "rolling_avg_days":
        lambda t, _: rolling_avg_days(t["fact_sensor_readings"], t["dim_sensor"]),
}


@dataclass(frozen=True)
class Outcome:
    """Where a report was written, or why it was not."""

    path: str | None = None
    error: str | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)


def run_business_queries(
    tables: Tables, as_of: date, out: str, names: Iterable[str] | None = None,
    reports: Mapping[str, Report] = REPORTS,
) -> dict[str, Outcome]:
    """Write the named reports below `out`, in order. One failing does not stop the others."""
    outcomes = {}
    for name in reports if names is None else names:
        try:
            path = f"{out}/{name}"
            reports[name](tables, as_of).write.mode("overwrite").parquet(path)
            outcomes[name] = Outcome(path=path)
        except Exception as error:  # noqa: BLE001 - whatever went wrong, the next report runs
            outcomes[name] = Outcome(error=f"{type(error).__name__}: {error}")
    return outcomes
