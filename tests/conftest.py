import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tracemill.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, memory="8g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smallest():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test data not there")
    return str(folder)


@pytest.fixture
def settings(spark):
    """Change session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def texts(spark):
    """A table of text columns from rows of values."""

    def make(columns, rows):
        schema = ", ".join(f"{name} string" for name in columns.split())
        return spark.createDataFrame(rows, schema)

    return make
