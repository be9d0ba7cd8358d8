import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from plantpulse.session import build  # noqa: E402
from plantpulse.streaming.verifier import use_state_store  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark__sql__shuffle__partitions": "4",
        "spark__driver__memory": "6g",
        "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    use_state_store(session)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from tuples and a DDL schema."""
    return lambda data, schema: spark.createDataFrame(data, schema)
