import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest

from fabpulse.operators import rolling
from fabpulse.operators.rolling import rolling_avg_days, rolling_avg_readings
from fabpulse.sources.dimensions import seed_dimensions

SCHEMA = ("reading_id string, sensor_sk int, machine_id string, sensor_type string,"
          " reading_ts timestamp, reading_value double")


def expected(readings, back=6):
    """Brute force over each machine's ordered readings."""
    machines = defaultdict(list)
    for rid, _, machine, _, ts, value in readings:
        machines[machine].append((ts is None, ts or datetime.max, rid, value))
    result = {}
    for machine, series in machines.items():
        series.sort()
        for i, (_, _, rid, _) in enumerate(series):
            frame = [v for *_, v in series[max(0, i - back):i + 1]]
            result[machine, rid] = sum(frame) / len(frame)
    return result


def random_readings(seed, n):
    """One machine holds most rows; many share one instant, some have no time at all."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        machine = rng.choice(["M1", "M1", "M1", "M2", "M3"])
        kind = rng.random()
        if kind < 0.3:
            ts = start + timedelta(days=3, hours=5)
        elif kind < 0.4:
            ts = None
        else:
            ts = start + timedelta(days=rng.choice([0, 1, 4, 40]), seconds=rng.randrange(86_400))
        out.append((f"r{i:05d}", 1, machine, "temperature", ts, round(rng.uniform(0, 100), 2)))
    return out


@pytest.fixture
def cut_in(spark):
    """Set the number of range partitions, and undo it."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {key: spark.conf.get(key) for key in keys}

    def set_parts(parts):
        spark.conf.set(keys[0], str(parts))
        spark.conf.set(keys[1], "false")

    yield set_parts
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("parts", [1, 4, 45, 120])
def test_cuts_do_not_change_the_average(spark, cut_in, parts):
    cut_in(parts)
    readings = random_readings(7, 600)
    fact = spark.createDataFrame(readings, SCHEMA)
    sensors = seed_dimensions(spark)["dim_sensor"]
    got = rolling_avg_readings(fact, sensors).collect()
    assert len(got) == len(readings)
    want = expected(readings)
    for row in got:
        assert row.rolling_avg_7d == pytest.approx(want[row.machine_id, row.reading_id])


def test_a_crowded_machine_is_really_cut(spark, cut_in):
    cut_in(30)
    readings = random_readings(3, 600)
    fact = spark.createDataFrame(readings, SCHEMA)
    series = fact.selectExpr(
        "machine_id", "reading_id", "coalesce(unix_micros(reading_ts), 9223372036854775807) AS _us")
    sizes = rolling.in_order(series).groupBy("machine_id", "_part").count().collect()
    assert max(r["count"] for r in sizes) < 120 and len(sizes) > 25


def test_result_is_ordered(spark):
    fact = spark.createDataFrame(random_readings(5, 200), SCHEMA)
    got = rolling_avg_readings(fact, seed_dimensions(spark)["dim_sensor"]).collect()
    keys = [(r.machine_id, r.reading_date is None, r.reading_date or date.max) for r in got]
    assert keys == sorted(keys)


def test_daily_average_covers_days_not_rows(spark):
    readings = [
        ("a", 1, "M", "temperature", datetime(2024, 1, 1, 1), 10.0),
        ("b", 1, "M", "temperature", datetime(2024, 1, 1, 2), 20.0),
        ("c", 1, "M", "temperature", datetime(2024, 1, 2, 1), 35.0),
        ("d", 1, "M", "temperature", datetime(2024, 1, 9, 1), 100.0),
        ("e", 2, "M", "vibration", datetime(2024, 1, 9, 1), 5.0),
        ("f", 1, "M", "temperature", None, 5.0),
    ]
    fact = spark.createDataFrame(readings, SCHEMA)
    got = rolling_avg_days(fact, seed_dimensions(spark)["dim_sensor"]).collect()
    assert [(r.reading_date.day, r.daily_avg, r.rolling_avg_7d) for r in got] == [
        (1, 15.0, 15.0), (2, 35.0, 25.0), (9, 100.0, 100.0)]
