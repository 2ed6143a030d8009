import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskloom.session import build_session, drop_scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def make(spark):
    """Rows and a schema text to a DataFrame."""

    def build(rows, schema):
        return spark.createDataFrame(rows, schema)

    return build
