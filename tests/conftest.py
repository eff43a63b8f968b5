from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from anemos.session import build_session  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture(scope="session")
def telemetry(spark, sf_dir):
    from anemos.catalog import fixtures

    return fixtures.telemetry(spark, sf_dir)


@pytest.fixture(scope="session")
def stored_telemetry(spark, telemetry, tmp_path_factory):
    """The samples as a table partitioned by day."""
    from anemos.sinks import write_days

    path = str(tmp_path_factory.mktemp("telemetry") / "table")
    write_days(telemetry, path, "time")
    return path
