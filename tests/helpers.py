"""Messages, landed files and sorted rows for the tests."""

from __future__ import annotations

import json
import uuid
from pathlib import Path

from fabpulse.layout import Layout


def message(message_id="a", machine="MACHINE_01", sensor="temperature", value="50.0",
            status="NORMAL", ts="2024-01-15T10:00:00+00:00", **changes) -> dict:
    return {
        "message_id": message_id, "machine_id": machine, "machine_type": "CNC Mill",
        "sensor_type": sensor, "value": value, "unit": "celsius", "location": "Plant-A",
        "status": status, "shift": "device", "ts": ts, "firmware_ver": "v1", **changes,
    }


def land(lake: Layout, day: str, *lines: dict | str) -> None:
    """Add a file of messages, given as dicts or raw lines, to one arrival day."""
    year, month, date = day.split("-")
    folder = Path(lake.bronze) / f"year={year}" / f"month={month}" / f"day={date}"
    folder.mkdir(parents=True, exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    (folder / f"{uuid.uuid4().hex}.json").write_text("\n".join(text) + "\n")


def publish(folder, *lines: dict | str) -> None:
    """Put messages where a stream over text files picks them up."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    text = [line if isinstance(line, str) else json.dumps(line) for line in lines]
    staged = Path(folder) / f".{uuid.uuid4().hex}"
    staged.write_text("\n".join(text) + "\n")
    staged.rename(Path(folder) / f"{uuid.uuid4().hex}.txt")


def rows(df, *columns) -> list[tuple]:
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
