"""One local session for all tests."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from inkweir.session import local_session

    session = local_session(cores=int(os.environ.get("TEST_CPUS", "4")), partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir("file://" + str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()
