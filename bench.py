"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_ALL      set to time every registered query
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from fabpulse.session import build_session  # noqa: E402

HEADLINE = (
    "silver_readings", "run_metrics", "gold_fact", "constraint_violations",
    "upsert_ignore", "upsert_replace",
    "bq01_hot_machines", "bq02_uptime", "bq03_shift_anomaly_rate",
    "bq04_rolling_avg", "bq04_rolling_avg_daily", "hourly_summary",
    "dash_temperature", "dash_live_readings", "dash_anomalies",
    "dash_machine_summary", "dash_anomaly_rate",
    "stream_bronze", "stream_anomalies", "stream_dead_letters",
    "batch_fact", "dash_export_stats", "table_row_counts", "silver_incremental",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("fabpulse-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["bq01_hot_machines"](spark, sf_dir).collect()  # start-up is not measured
    seconds = {}
    for name in QUERIES if os.environ.get("BENCH_ALL") else HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
