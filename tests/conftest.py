import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from larkspur.session import build_session  # noqa: E402

DATA = os.environ.get("LARKSPUR_TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "larkspur-tests",
        master="local[8]",
        shuffle_partitions=8,
        conf={"spark.driver.memory": "12g", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return f"{DATA}/sf0.01"
