import os

import pytest

from tallyhouse.session import local_session

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("SMALL_SF_DIR", SMALL)


@pytest.fixture(scope="session")
def medium():
    return os.environ.get("MEDIUM_SF_DIR", MEDIUM)
