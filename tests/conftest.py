from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tideframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = build_session(
        "tests", "local[4]", 4,
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "work"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


def rows(df, *cols):
    """Rows as sorted tuples, NULL first."""
    df = df.select(*cols) if cols else df
    return sorted(
        (tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect()),
        key=lambda t: tuple((v is not None, str(type(v)), v) for v in t),
    )


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
