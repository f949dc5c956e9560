from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from talentsift.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "talentsift-tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def plan_of(df) -> str:
    """The physical plan; after a run, the adaptive plan also prints the one it started from."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
