from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallyline.session import open_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = open_session(
        "tests",
        master="local[8]",
        shuffle_partitions=8,
        settings={
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.sql.catalogImplementation": "in-memory",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("catalog")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
