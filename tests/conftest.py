from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tierline.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = get_session(
        "tierline-tests",
        master="local[4]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collect as a sorted list of tuples (order-insensitive compare)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
