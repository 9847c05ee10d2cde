"""Jobs for spark-submit: `python -m fabpulse <job> --root <lake>`."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, date, datetime

from fabpulse.layout import Layout
from fabpulse.plans.batch import run_batch
from fabpulse.plans.hourly import run_hourly
from fabpulse.plans.reports import REPORTS, run_business_queries
from fabpulse.session import build_session
from fabpulse.sources.tables import read_table
from fabpulse.streaming.anomalies import capture_anomalies
from fabpulse.streaming.landing import write_bronze_stream
from fabpulse.streaming.source import read_reading_stream


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="fabpulse", description=__doc__)
    parser.add_argument("job", choices=("batch", "hourly", "reports", "land", "capture"))
    parser.add_argument("--root", required=True, help="root URI of the lake")
    parser.add_argument("--date", type=date.fromisoformat, help="event date, or date of a report")
    parser.add_argument("--partition", type=date.fromisoformat, action="append",
                        help="arrival day to process; all when not given")
    parser.add_argument("--skip-silver", action="store_true", help="start from stored Silver")
    parser.add_argument("--report", action="append", choices=sorted(REPORTS))
    parser.add_argument("--source", default="text", help="format of the message stream")
    parser.add_argument("--path", help="path of the message stream, for file sources")
    parser.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                        help="option of the message stream")
    parser.add_argument("--once", action="store_true", help="stop when all messages are read")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Returns the exit code: 1 if any step or report failed."""
    args = parse(argv)
    failed = False
    spark = build_session(f"fabpulse-{args.job}")
    lake = Layout(args.root)
    today = datetime.now(UTC).date()
    if args.job == "batch":
        report = run_batch(spark, lake, args.skip_silver, args.date, args.partition)
        print(json.dumps(report, default=str))
        failed = bool(report.get("errors"))
    elif args.job == "hourly":
        print(run_hourly(spark, lake, args.date))
    elif args.job == "reports":
        tables = {n: read_table(spark, lake, n) for n in ("fact_sensor_readings", "dim_sensor")}
        out = f"{lake.root}/reports"
        outcomes = run_business_queries(tables, args.date or today, out, args.report)
        print(json.dumps({name: outcome.error or outcome.path for name, outcome in outcomes.items()}))
        failed = any(outcome.error for outcome in outcomes.values())
    else:
        options = dict(option.split("=", 1) for option in args.option)
        messages = read_reading_stream(spark, args.path, args.source, **options)
        trigger = {"availableNow": True} if args.once else {}
        start = write_bronze_stream if args.job == "land" else capture_anomalies
        start(messages, lake, **trigger).awaitTermination()  # raises what the stream failed with
    return int(failed)


if __name__ == "__main__":
    sys.exit(main())
