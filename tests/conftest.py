from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from kilnwatch.session import build_session

    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "6g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
