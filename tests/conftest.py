import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom.session import build_session  # noqa: E402
from eventloom.sources.scratch import clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "eventloom-tests",
        master="local[8]",
        shuffle_partitions=8,
        extra={"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
