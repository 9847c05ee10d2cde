from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fabpulse.layout import Layout  # noqa: E402
from fabpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("fabpulse-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g", "spark.sql.ui.retainedExecutions": "10",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path) -> Layout:
    return Layout(str(tmp_path / "lake"))
