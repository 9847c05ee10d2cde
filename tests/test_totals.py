"""Day totals: only changed days are computed, and they always equal those of the whole table."""

from __future__ import annotations

import shutil
from datetime import datetime
from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fabpulse.operators.dashboards import day_totals
from fabpulse.plans import totals
from fabpulse.plans.dashboards import build_dashboards, datasets
from fabpulse.plans.totals import FACT, refresh_day_totals
from fabpulse.schemas import TABLES
from fabpulse.sinks.day_files import NO_DAY
from fabpulse.sinks.tables import append_missing, ensure_table, replace_rows
from fabpulse.sources.tables import read_table


def facts(spark, ids, day, value=10.0):
    ts = None if day is None else datetime(2024, 1, day, 12)
    return spark.createDataFrame(
        [(f"{i}", 1, 1, value + n, ts, f"M{n % 2}", "temperature", "NORMAL", "morning", n % 3 == 0, ts, ts)
         for n, i in enumerate(ids)], TABLES[FACT].schema)


def load(spark, lake, ids, day, **changes):
    return append_missing(spark, lake, FACT, facts(spark, ids, day, **changes), [F.col("reading_ts")])


def files(lake):
    return {str(p) for p in Path(lake.day_totals, "days").rglob("*.parquet")}


def same_as_whole(spark, lake, refreshed):
    columns = refreshed.totals.columns
    assert rows(refreshed.totals, *columns) == rows(day_totals(read_table(spark, lake, FACT)), *columns)


@pytest.fixture
def filled(spark, lake):
    ensure_table(spark, lake, FACT)
    for day in (1, 2, 3, None):
        load(spark, lake, [f"{day}-{n}" for n in range(7)], day)
    return lake


def test_first_run_then_nothing(spark, filled):
    first = refresh_day_totals(spark, filled)
    assert first.computed == {"2024-01-01", "2024-01-02", "2024-01-03", NO_DAY}
    same_as_whole(spark, filled, first)
    before = files(filled)
    again = refresh_day_totals(spark, filled)
    assert not again.computed and not again.dropped and files(filled) == before


def test_a_load_touches_its_days_only(spark, filled):
    refresh_day_totals(spark, filled)
    kept = {f for f in files(filled) if "2024-01-02" not in f}
    load(spark, filled, ["late", "2-0"], 2, value=99.0)
    refreshed = refresh_day_totals(spark, filled)
    assert refreshed.computed == {"2024-01-02"}
    assert kept <= files(filled)
    same_as_whole(spark, filled, refreshed)


def test_replaced_and_removed_days(spark, filled):
    refresh_day_totals(spark, filled)
    replace_rows(spark, filled, FACT, facts(spark, ["3-1", "3-2"], 3, value=-5.0), [F.col("reading_ts")])
    shutil.rmtree(Path(filled.table(FACT)) / "partition_day=2024-01-01")
    refreshed = refresh_day_totals(spark, filled)
    assert refreshed.computed == {"2024-01-03"} and refreshed.dropped == {"2024-01-01"}
    same_as_whole(spark, filled, refreshed)


def test_a_run_that_failed_before_it_wrote_the_names(spark, filled, monkeypatch):
    refresh_day_totals(spark, filled)
    load(spark, filled, ["late"], 1)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(totals, "store_names", fail)
        refresh_day_totals(spark, filled)
    refreshed = refresh_day_totals(spark, filled)
    assert refreshed.computed == {"2024-01-01"}
    same_as_whole(spark, filled, refreshed)


def test_unchanged_days_are_not_read(spark, filled):
    refresh_day_totals(spark, filled)
    load(spark, filled, ["late"], 3)
    for day in (1, 2):  # no reader of these files would get far
        for file in Path(filled.table(FACT), f"partition_day=2024-01-0{day}").glob("*.parquet"):
            file.write_bytes(b"unreadable")
    refreshed = refresh_day_totals(spark, filled)
    assert refreshed.totals.agg(F.sum("total_readings")).first()[0] == 29


def test_dashboards_equal_a_full_run(spark, filled):
    build_dashboards(spark, filled)
    load(spark, filled, ["x", "y", "z"], 2, value=50.0)
    build_dashboards(spark, filled)
    whole = datasets(read_table(spark, filled, FACT))["anomaly_rate"]
    found = spark.read.schema(whole.schema).json(f"{filled.dashboards}/anomaly_rate")
    assert rows(found, *whole.columns) == rows(whole, *whole.columns)


def test_empty(spark, lake):
    assert refresh_day_totals(spark, lake).totals.count() == 0
    ensure_table(spark, lake, FACT)
    assert refresh_day_totals(spark, lake).totals.count() == 0
