"""The same queries in SQL, over the `events` table alone."""

from __future__ import annotations

FEED = """
WITH e AS (
  SELECT event_id, ts AS event_ts, value AS number,
         CASE WHEN event_id % 101 <> 0 THEN CAST(event_id AS VARCHAR) END AS message_id,
         concat('MACHINE_0', CAST(user_id % 6 + 1 AS VARCHAR)) AS machine_id,
         CASE event_type WHEN 'click' THEN 'temperature' WHEN 'view' THEN 'vibration'
              WHEN 'purchase' THEN 'pressure' WHEN 'signup' THEN 'power'
              ELSE 'humidity' END AS sensor_type,
         CASE WHEN event_id % 83 = 0 OR event_id % 113 = 0 THEN NULL
              WHEN event_id % 89 = 0 THEN 'NORMAL'
              WHEN event_type = 'click'    AND value > 90  THEN 'HIGH'
              WHEN event_type = 'purchase' AND value > 160 THEN 'HIGH'
              WHEN event_type = 'view'     AND value > 15  THEN 'WARN'
              WHEN event_type = 'signup'   AND value > 60  THEN 'WARN'
              ELSE 'NORMAL' END AS status
  FROM events),
deliveries AS (
  SELECT *, 0 AS late, CAST(number AS VARCHAR) AS reported, event_ts AS sent FROM e
  UNION ALL
  SELECT *, 1, CAST(CAST(number AS DECIMAL(18,2)) + 1 AS VARCHAR),
         event_ts + CASE WHEN event_id % 100 = 0 THEN INTERVAL '1' DAY ELSE INTERVAL '1' SECOND END
  FROM e WHERE event_id % 50 = 0),
raw AS (
  SELECT event_id, message_id, machine_id, sensor_type, status, event_id % 113 = 0 AS no_status,
         CASE WHEN event_id % 97 = 0 THEN 'n/a' WHEN event_id % 131 = 0 THEN NULL
              ELSE reported END AS value,
         CASE WHEN late = 1 THEN CAST(sent AS VARCHAR) WHEN event_id % 103 = 0 THEN 'not a time'
              WHEN event_id % 107 = 0 THEN NULL ELSE CAST(sent AS VARCHAR) END AS ts,
         CAST(sent AS DATE) AS arrived
  FROM deliveries),
lines AS (
  SELECT message_id, machine_id, sensor_type, value, status, ts, arrived FROM raw
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, arrived FROM raw WHERE event_id % 109 = 0),
typed AS (
  SELECT *, TRY_CAST(value AS DOUBLE) AS reading_value, TRY_CAST(ts AS TIMESTAMP) AS reading_ts
  FROM raw),
accepted AS (
  SELECT *,
         CASE WHEN (sensor_type = 'temperature' AND reading_value > 90)
                OR (sensor_type = 'vibration'   AND reading_value > 15)
                OR (sensor_type = 'pressure'    AND reading_value > 160)
                OR (sensor_type = 'power'       AND reading_value > 60)
              THEN TRUE ELSE FALSE END AS is_anomaly,
         CASE WHEN hour(reading_ts) >= 6  AND hour(reading_ts) < 14 THEN 'morning'
              WHEN hour(reading_ts) >= 14 AND hour(reading_ts) < 22 THEN 'afternoon'
              ELSE 'night' END AS shift
  FROM typed WHERE reading_value IS NOT NULL AND message_id IS NOT NULL),
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY message_id ORDER BY reading_ts NULLS LAST, arrived) AS rn FROM accepted)
  WHERE rn = 1),
dim_machine(machine_sk, machine_id, machine_type, plant, status) AS (VALUES
  (1, 'MACHINE_01', 'CNC Mill', 'Plant-A', 'active'),
  (2, 'MACHINE_02', 'Conveyor Belt', 'Plant-A', 'active'),
  (3, 'MACHINE_03', 'Air Compressor', 'Plant-B', 'active'),
  (4, 'MACHINE_04', 'Industrial Oven', 'Plant-B', 'active'),
  (5, 'MACHINE_05', 'Hydraulic Press', 'Plant-C', 'active')),
dim_sensor(sensor_sk, sensor_type, unit, anomaly_threshold) AS (VALUES
  (1, 'temperature', 'celsius', CAST(90 AS DOUBLE)), (2, 'vibration', 'mm/s', 15),
  (3, 'pressure', 'PSI', 160), (4, 'power', 'kW', 60)),
dim_location(location_sk, location_id, plant_name, city, state) AS (VALUES
  (1, 'Plant-A', 'Plant Alpha', 'Mumbai', 'Maharashtra'),
  (2, 'Plant-B', 'Plant Beta', 'Pune', 'Maharashtra'),
  (3, 'Plant-C', 'Plant Gamma', 'Bangalore', 'Karnataka')),
dim_date AS (
  SELECT CAST(10000 * y + 100 * m + n AS INTEGER) AS date_sk, full_date, y AS year, m AS month,
         n AS day, w AS day_of_week, w = 0 OR w = 6 AS is_weekend
  FROM (SELECT full_date, CAST(extract('year' FROM full_date) AS INTEGER) AS y,
               CAST(extract('month' FROM full_date) AS INTEGER) AS m,
               CAST(extract('day' FROM full_date) AS INTEGER) AS n,
               CAST(extract('dow' FROM full_date) AS INTEGER) AS w
        FROM (SELECT CAST(unnest(generate_series(
                TIMESTAMP '2024-01-01', TIMESTAMP '2026-12-31', INTERVAL 1 DAY)) AS DATE) AS full_date))),
fact AS (
  SELECT a.message_id AS reading_id, m.machine_sk, s.sensor_sk, a.reading_value, a.reading_ts,
         a.machine_id, a.sensor_type, a.status, a.shift, a.is_anomaly
  FROM silver a JOIN dim_machine m USING (machine_id) JOIN dim_sensor s USING (sensor_type)),
hours AS (
  SELECT machine_id, sensor_type, date_trunc('hour', reading_ts) AS hour_ts, reading_value,
         CASE WHEN status <> 'NORMAL' THEN 1 ELSE 0 END AS flagged
  FROM fact WHERE reading_ts IS NOT NULL),
hourly AS (
  SELECT concat_ws('_', machine_id, sensor_type, strftime(hour_ts, '%Y%m%d%H')) AS summary_id,
         machine_id, sensor_type, hour_ts, AVG(reading_value) AS avg_value,
         MIN(reading_value) AS min_value, MAX(reading_value) AS max_value,
         CAST(SUM(flagged) AS INTEGER) AS anomaly_count, CAST(COUNT(*) AS INTEGER) AS reading_count
  FROM hours GROUP BY ALL),
totals AS (
  SELECT machine_id, sensor_type, AVG(reading_value) AS a, MAX(reading_value) AS hi,
         MIN(reading_value) AS lo, COUNT(*) AS n, COUNT(*) FILTER (WHERE is_anomaly) AS bad
  FROM fact GROUP BY machine_id, sensor_type)
"""

RAW_FIELDS = "message_id, machine_id, sensor_type, value, status, ts"
REJECTED = "reading_value IS NULL OR message_id IS NULL"
HOURLY = "* REPLACE (ROUND(avg_value, 8) AS avg_value)"


def _newest(columns: str, where: str, limit: int) -> str:
    return (
        f"SELECT {columns} FROM fact WHERE {where}"
        f" ORDER BY reading_ts DESC NULLS LAST, reading_id LIMIT {limit}"
    )


def _sensor(sensor: str, threshold: int) -> str:
    return _newest(
        "machine_id AS machine, COALESCE(reading_value, 0.0) AS value,"
        " CAST(reading_ts AS VARCHAR) AS ts, status, is_anomaly, shift,"
        f" CASE WHEN reading_value > {threshold} THEN 'ABOVE_THRESHOLD' ELSE 'NORMAL' END"
        " AS threshold_status",
        f"sensor_type = '{sensor}'", 2000,
    )


DASHBOARDS = {
    "temperature": _sensor("temperature", 90),
    "vibration": _sensor("vibration", 15),
    "pressure": _sensor("pressure", 160),
    "power": _sensor("power", 60),
    "live_readings": _newest(
        "machine_id AS machine, sensor_type AS sensor, COALESCE(reading_value, 0.0) AS value,"
        " CAST(reading_ts AS VARCHAR) AS ts, status, shift, is_anomaly", "TRUE", 2000,
    ),
    "anomalies": _newest(
        "machine_id AS machine, sensor_type AS sensor, COALESCE(reading_value, 0.0) AS value,"
        " status, CAST(reading_ts AS VARCHAR) AS ts, shift", "is_anomaly", 200,
    ),
    "machine_summary": """
        SELECT machine_id AS machine, sensor_type AS sensor, ROUND(a, 2) AS avg_value,
               ROUND(hi, 2) AS max_value, ROUND(lo, 2) AS min_value, n AS total_readings,
               bad AS anomaly_count, ROUND(100.0 * bad / n, 1) AS anomaly_pct
        FROM totals""",
    "anomaly_rate": """
        SELECT machine_id AS machine, CAST(SUM(n) AS BIGINT) AS total,
               CAST(SUM(bad) AS BIGINT) AS anomalies,
               ROUND(100.0 * SUM(bad) / SUM(n), 1) AS anomaly_pct
        FROM totals GROUP BY machine_id""",
}

STATEMENTS = {
    "bronze_scan": f"SELECT {RAW_FIELDS} FROM lines",
    "bronze_scan_one_day": f"SELECT {RAW_FIELDS} FROM lines WHERE arrived = DATE '2024-01-15'",
    "stream_bronze": f"SELECT {RAW_FIELDS} FROM lines",
    "typed_readings": "SELECT message_id, reading_value, reading_ts FROM typed",
    "quarantine": f"SELECT {RAW_FIELDS} FROM typed WHERE {REJECTED}",
    "quarantine_files": f"""
        SELECT {RAW_FIELDS} FROM typed WHERE {REJECTED}
        UNION ALL SELECT {RAW_FIELDS} FROM lines WHERE machine_id IS NULL""",
    "silver_readings": """
        SELECT message_id, machine_id, sensor_type, status, reading_value, reading_ts,
               is_anomaly, shift FROM silver""",
    "run_metrics": f"""
        SELECT (SELECT COUNT(*) FROM lines) AS input_rows,
               (SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM accepted) AS quarantined,
               (SELECT COUNT(*) FROM accepted WHERE reading_ts IS NULL) AS undated,
               (SELECT COUNT(*) FROM silver) AS silver_rows,
               (SELECT COUNT(DISTINCT arrived) FROM silver) AS partitions,
               (SELECT COUNT(*) FROM accepted) - (SELECT COUNT(*) FROM silver) AS duplicates""",
    "anomaly_flags": """
        SELECT sensor_type, COUNT(*) FILTER (WHERE is_anomaly) AS anomalies, COUNT(*) AS readings
        FROM accepted GROUP BY sensor_type""",
    "shift_of_reading": "SELECT shift, COUNT(*) AS readings FROM accepted GROUP BY shift",
    "device_status_of_reading": """
        SELECT message_id, reading_ts,
               CASE WHEN sensor_type = 'temperature' AND reading_value > 90  THEN 'HIGH'
                    WHEN sensor_type = 'pressure'    AND reading_value > 160 THEN 'HIGH'
                    WHEN sensor_type = 'vibration'   AND reading_value > 15  THEN 'WARN'
                    WHEN sensor_type = 'power'       AND reading_value > 60  THEN 'WARN'
                    ELSE 'NORMAL' END AS device_status
        FROM accepted""",
    "dim_machine_readings": """
        SELECT d.*, (SELECT COUNT(*) FROM silver s WHERE s.machine_id = d.machine_id) AS readings
        FROM dim_machine d""",
    "dim_sensor_readings": """
        SELECT d.*, (SELECT COUNT(*) FROM silver s WHERE s.sensor_type = d.sensor_type) AS readings
        FROM dim_sensor d""",
    "dim_location_readings": """
        SELECT d.*, (SELECT COUNT(*) FROM silver s JOIN dim_machine m USING (machine_id)
                     WHERE m.plant = d.location_id) AS readings
        FROM dim_location d""",
    "dim_date_readings": """
        SELECT d.*, COALESCE(c.n, 0) AS readings
        FROM dim_date d LEFT JOIN (
          SELECT CAST(reading_ts AS DATE) AS day_of_reading, COUNT(*) AS n
          FROM silver GROUP BY 1) c ON c.day_of_reading = d.full_date""",
    "gold_fact": "SELECT * FROM fact",
    "batch_fact": "SELECT * FROM fact",
    "role_analyst_fact": "SELECT * FROM fact",
    "gold_orphans": """
        SELECT message_id, machine_id, sensor_type,
               machine_id NOT IN (SELECT machine_id FROM dim_machine) AS unknown_machine,
               sensor_type NOT IN (SELECT sensor_type FROM dim_sensor) AS unknown_sensor
        FROM silver
        WHERE machine_id NOT IN (SELECT machine_id FROM dim_machine)
           OR sensor_type NOT IN (SELECT sensor_type FROM dim_sensor)""",
    "constraint_violations": """
        , machines AS (
          SELECT machine_sk, CASE WHEN machine_sk <> 3 THEN machine_id END AS machine_id
          FROM dim_machine WHERE machine_sk <> 5
          UNION ALL SELECT machine_sk, machine_id FROM dim_machine WHERE machine_sk = 1),
        sensors AS (
          SELECT sensor_sk, sensor_type FROM dim_sensor
          UNION ALL SELECT NULL, sensor_type FROM dim_sensor WHERE sensor_sk = 4),
        facts AS (
          SELECT t.message_id AS reading_id, m.machine_sk, s.sensor_sk
          FROM typed t JOIN dim_machine m USING (machine_id) JOIN dim_sensor s USING (sensor_type)
          WHERE t.reading_value IS NOT NULL),
        cells(table_name, col, v) AS (
          SELECT 'dim_machine', 'machine_sk', CAST(machine_sk AS VARCHAR) FROM machines
          UNION ALL SELECT 'dim_machine', 'machine_id', machine_id FROM machines
          UNION ALL SELECT 'dim_sensor', 'sensor_sk', CAST(sensor_sk AS VARCHAR) FROM sensors
          UNION ALL SELECT 'dim_sensor', 'sensor_type', sensor_type FROM sensors
          UNION ALL SELECT 'fact_sensor_readings', 'reading_id', reading_id FROM facts)
        SELECT table_name, 'unique ' || col AS rule,
               COUNT(*) FILTER (WHERE n > 1 AND v IS NOT NULL) AS violations
        FROM (SELECT table_name, col, v, COUNT(*) AS n FROM cells GROUP BY ALL) GROUP BY ALL
        UNION ALL
        SELECT table_name, 'not null ' || col, COUNT(*) FILTER (WHERE v IS NULL)
        FROM cells GROUP BY ALL
        UNION ALL
        SELECT 'fact_sensor_readings', 'machine_sk in dim_machine', COUNT(*)
        FROM facts f WHERE NOT EXISTS (SELECT 1 FROM machines m WHERE m.machine_sk = f.machine_sk)
        UNION ALL
        SELECT 'fact_sensor_readings', 'sensor_sk in dim_sensor', COUNT(*)
        FROM facts f WHERE NOT EXISTS (SELECT 1 FROM sensors s WHERE s.sensor_sk = f.sensor_sk)""",
    "upsert_ignore": """
        SELECT reading_id, machine_sk, sensor_sk,
               CASE WHEN reading_ts < TIMESTAMP '2024-01-16' THEN -1.0 ELSE reading_value END
                 AS reading_value, reading_ts
        FROM fact""",
    "upsert_replace": f"""
        SELECT {HOURLY[:-1]}, CAST(CASE WHEN hour_ts < TIMESTAMP '2024-01-16' THEN reading_count
                                        ELSE 0 END AS INTEGER) AS reading_count) FROM hourly""",
    "bq01_hot_machines": """
        SELECT machine_id, MAX(reading_value) AS max_temp,
               SUM(CASE WHEN status = 'HIGH' THEN 1 ELSE 0 END)::BIGINT AS high_count,
               COUNT(*) AS total_readings
        FROM fact WHERE sensor_sk = 1 GROUP BY machine_id""",
    "bq02_uptime": """
        , january AS (
          SELECT machine_id, COUNT(*) AS actual_readings FROM fact
          WHERE reading_ts >= DATE '2024-01-01' AND reading_ts < DATE '2024-02-01' GROUP BY machine_id)
        SELECT machine_id, actual_readings,
               ROUND(100.0 * actual_readings / (4 * 24 * day(last_day(DATE '2024-01-15'))), 1) AS uptime_pct
        FROM january""",
    "bq03_shift_anomaly_rate": """
        , per_shift AS (
          SELECT shift, COUNT(*) AS total_readings,
                 SUM(CASE WHEN status <> 'NORMAL' THEN 1 ELSE 0 END)::BIGINT AS anomalies
          FROM fact GROUP BY shift)
        SELECT *, ROUND(100.0 * anomalies / total_readings, 2) AS anomaly_pct FROM per_shift""",
    "bq04_rolling_avg": """
        SELECT f.machine_id, CAST(f.reading_ts AS DATE) AS reading_date, f.reading_id,
               ROUND(AVG(f.reading_value) OVER (
                 PARTITION BY f.machine_id ORDER BY f.reading_ts NULLS LAST, f.reading_id
                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS rolling_avg_7d
        FROM fact f JOIN dim_sensor s ON f.sensor_sk = s.sensor_sk
        WHERE s.sensor_type = 'temperature'""",
    "bq04_rolling_avg_daily": """
        SELECT machine_id, reading_date, ROUND(daily, 8) AS daily_avg,
               ROUND(AVG(daily) OVER (
                 PARTITION BY machine_id ORDER BY reading_date
                 RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 8) AS rolling_avg_7d
        FROM (SELECT f.machine_id, CAST(f.reading_ts AS DATE) AS reading_date,
                     AVG(f.reading_value) AS daily
              FROM fact f JOIN dim_sensor s ON f.sensor_sk = s.sensor_sk
              WHERE s.sensor_type = 'temperature' AND f.reading_ts IS NOT NULL GROUP BY 1, 2)""",
    "hourly_summary": f"SELECT {HOURLY} FROM hourly",
    "hourly_summary_one_day":
        f"SELECT {HOURLY} FROM hourly WHERE CAST(hour_ts AS DATE) = DATE '2024-01-15'",
    **{f"dash_{name}": statement for name, statement in DASHBOARDS.items()},
    "dash_export_stats": " UNION ALL ".join(
        f"(SELECT '{name}' AS dataset, COUNT(*) AS row_count, "
        + ("CAST(COUNT(*) FILTER (WHERE is_anomaly) AS VARCHAR)"
           if "is_anomaly" in statement.split(" FROM ")[0] else "'n/a'")
        + f" AS anomaly_rows FROM ({statement}))"
        for name, statement in DASHBOARDS.items()
    ),
    "table_row_counts": " UNION ALL ".join(
        f"(SELECT '{name}' AS table_name, CAST(COUNT(*) AS VARCHAR) AS row_count FROM {source})"
        for name, source in {
            "bronze": "raw", "silver": "silver", "dim_machine": "dim_machine",
            "dim_sensor": "dim_sensor", "dim_location": "dim_location", "dim_date": "dim_date",
            "fact_sensor_readings": "fact", "hourly_machine_summary": "hourly",
        }.items()
    ) + " UNION ALL (SELECT 'anomaly_log', 'n/a')",
    "role_engineer_counts": "SELECT machine_id, COUNT(*) AS n FROM fact GROUP BY machine_id",
    "role_viewer_summary":
        "SELECT machine_id, ROUND(AVG(avg_value), 8) AS mean_value FROM hourly GROUP BY machine_id",
    "stream_anomalies": "SELECT * FROM captured",
    "stream_restart": "SELECT * FROM captured",
    "stream_in_batches": "SELECT reading_id, machine_id, sensor_type, status FROM captured",
    "anomaly_keys": """
        SELECT message_id AS reading_id, message_id IN (SELECT reading_id FROM captured) AS held
        FROM typed WHERE message_id IS NOT NULL GROUP BY message_id""",
    "role_sample": "SELECT LEAST(COUNT(*), 3) AS sampled, LEAST(COUNT(*), 3) AS known FROM fact",
    "stream_dead_letters": """
        SELECT message_id, error FROM judged WHERE error IS NOT NULL
        UNION ALL SELECT NULL, 'not a JSON object' FROM lines WHERE machine_id IS NULL""",
}
STATEMENTS["silver_files"] = STATEMENTS["silver_incremental"] = STATEMENTS["silver_readings"]
STATEMENTS["hourly_stored"] = STATEMENTS["hourly_summary_one_day"]
STATEMENTS["rolling_refreshed"] = STATEMENTS["bq04_rolling_avg"]
STATEMENTS["dash_refreshed"] = STATEMENTS["dash_machine_summary"]
STATEMENTS["dash_stored"] = STATEMENTS["dash_live_readings"]
STATEMENTS["report_stored"] = STATEMENTS["bq01_hot_machines"]
STATEMENTS["role_over_lake"] = STATEMENTS["role_engineer_counts"]

CAPTURE = """,
judged AS (
  SELECT message_id, machine_id, sensor_type, reading_value, status, reading_ts,
         CASE WHEN no_status THEN 'missing field: status'
              WHEN message_id IS NULL THEN 'message_id is null'
              WHEN value IS NULL THEN 'value is null'
              WHEN reading_value IS NULL THEN 'not a number: ' || value
              WHEN ts IS NOT NULL AND reading_ts IS NULL THEN 'not a time: ' || ts END AS error
  FROM typed WHERE status IS DISTINCT FROM 'NORMAL'),
captured AS (
  SELECT message_id AS reading_id, machine_id, sensor_type, reading_value, status, reading_ts
  FROM judged WHERE error IS NULL
  QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY reading_ts NULLS LAST) = 1)
"""

ORACLES = {
    name: FEED + (CAPTURE if "captured" in statement or name.startswith("stream_") else "") + statement
    for name, statement in STATEMENTS.items()
}
