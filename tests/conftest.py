"""One local session for all tests."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from cohortspark.session import local_session

    session = local_session(cores=4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    return session
