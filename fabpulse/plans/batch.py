"""One batch cycle over all layers."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from datetime import UTC, date, datetime

from pyspark.sql import SparkSession

from fabpulse.layout import Layout
from fabpulse.operators.checks import table_row_counts
from fabpulse.plans.dashboards import build_dashboards
from fabpulse.plans.gold import build_gold
from fabpulse.plans.hourly import run_hourly
from fabpulse.plans.silver import build_silver
from fabpulse.sources.bronze import has_input
from fabpulse.sources.tables import table_or_none

log = logging.getLogger(__name__)

COUNTED_TABLES = ("fact_sensor_readings", "anomaly_log", "hourly_machine_summary")


def run_batch(
    spark: SparkSession, layout: Layout, skip_silver: bool = False,
    target_date: date | None = None, partitions: Iterable[date] | None = None,
) -> dict[str, object]:
    """Silver, Gold, dashboards, hourly summaries of `target_date` (today by default).

    Nothing runs before the first message has landed. A failing step is reported under
    `errors` and does not stop the later ones, which then work on what is stored.
    """
    if not has_input(spark, layout.bronze):
        return {}
    days = None if partitions is None else list(partitions)
    day = target_date or datetime.now(UTC).date()
    steps = {
        "silver": lambda: build_silver(spark, layout, days),
        "gold": lambda: build_gold(spark, layout, days),
        "dashboards": lambda: build_dashboards(spark, layout),
        "hourly": lambda: run_hourly(spark, layout, day),
        "row_counts": lambda: stored_row_counts(spark, layout),
    }
    if skip_silver:
        del steps["silver"]
    report: dict[str, object] = {"errors": {}}
    for name, step in steps.items():
        try:
            report[name] = step()
        except Exception as error:  # noqa: BLE001 - whatever went wrong, the next step runs
            log.exception("step %s failed", name)
            report["errors"][name] = str(error)
    return report


def stored_row_counts(spark: SparkSession, layout: Layout) -> dict[str, int | None]:
    """Rows per table; None for a table that is absent."""
    tables = {name: table_or_none(spark, layout, name) for name in COUNTED_TABLES}
    return {r["table_name"]: r["row_count"] for r in table_row_counts(spark, tables).collect()}
