"""One session for all tests; helpers that hold a query against its SQL."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from quirelake.session import get_session, release_stages

    session = get_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.default.parallelism": "4"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_stages()
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    if not os.path.isdir(DATA):
        pytest.skip("the test tables are not here")
    return DATA


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
