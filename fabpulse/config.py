"""Fixed values of the data model: thresholds, shifts, seed rows, roles."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# A reading strictly above its sensor's threshold is anomalous.
ANOMALY_THRESHOLDS = {
    "temperature": 90.0,
    "vibration": 15.0,
    "pressure": 160.0,
    "power": 60.0,
}

# What a device reports when a reading is above the threshold.
NORMAL = "NORMAL"
DEVICE_ALARMS = {
    "temperature": "HIGH",
    "pressure": "HIGH",
    "vibration": "WARN",
    "power": "WARN",
}

# First and last full hour of each shift; any other hour is night.
SHIFT_HOURS = {"morning": (6, 13), "afternoon": (14, 21)}
REMAINING_SHIFT = "night"

# Seed rows of the dimensions, in the column order of the schemas.
MACHINES = [
    (1, "MACHINE_01", "CNC Mill", "Plant-A", "active"),
    (2, "MACHINE_02", "Conveyor Belt", "Plant-A", "active"),
    (3, "MACHINE_03", "Air Compressor", "Plant-B", "active"),
    (4, "MACHINE_04", "Industrial Oven", "Plant-B", "active"),
    (5, "MACHINE_05", "Hydraulic Press", "Plant-C", "active"),
]
SENSORS = [
    (1, "temperature", "celsius", 90.0),
    (2, "vibration", "mm/s", 15.0),
    (3, "pressure", "PSI", 160.0),
    (4, "power", "kW", 60.0),
]
LOCATIONS = [
    (1, "Plant-A", "Plant Alpha", "Mumbai", "Maharashtra"),
    (2, "Plant-B", "Plant Beta", "Pune", "Maharashtra"),
    (3, "Plant-C", "Plant Gamma", "Bangalore", "Karnataka"),
]

# The calendar, end exclusive.
CALENDAR_START = date(2024, 1, 1)
CALENDAR_END = date(2027, 1, 1)

# Expected reading rate behind the uptime report.
READING_INTERVAL_S = 5
SENSORS_PER_MACHINE = 4

# Rows per dashboard dataset, landing interval of the stream.
DASHBOARD_ROWS = 2000
ANOMALY_ROWS = 200
LANDING_INTERVAL = "60 seconds"


@dataclass(frozen=True)
class Role:
    """What a role may read: its tables, minus the hidden columns."""

    tables: frozenset[str]
    hidden_columns: frozenset[str]


# Who sees what.
ROLES = {
    "engineer": Role(
        frozenset({
            "fact_sensor_readings", "dim_machine", "dim_sensor", "dim_location",
            "dim_date", "anomaly_log", "hourly_machine_summary",
        }),
        frozenset(),
    ),
    "analyst": Role(
        frozenset({
            "fact_sensor_readings", "dim_machine", "dim_sensor", "dim_location",
            "dim_date", "hourly_machine_summary",
        }),
        frozenset({"_ingested_at", "_loaded_at"}),
    ),
    "viewer": Role(
        frozenset({"hourly_machine_summary", "dim_machine"}),
        frozenset(),
    ),
}
