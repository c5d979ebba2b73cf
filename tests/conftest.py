from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from atlasweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", master="local[4]", spark__sql__shuffle__partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
        spark__python__sql__dataFrameDebugging__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a Column on a one-row frame with the given string columns."""

    def run(column, **values):
        schema = ", ".join(f"{k} string" for k in values) or "x string"
        row = tuple(values.values()) or (None,)
        return spark.createDataFrame([row], schema).select(column.alias("r")).first()["r"]

    return run
