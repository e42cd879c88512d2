import os

import pytest


@pytest.fixture(scope="session")
def large():
    return os.environ.get("LARGE_SF_DIR", "/root/testdata/sf0.1")
