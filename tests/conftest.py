import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import get_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "starloom-tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small DataFrame from a schema string and rows."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


@pytest.fixture(scope="session")
def small():
    return SMALL


def column(df, name):
    return [r[name] for r in df.collect()]
