import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from review_engine.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests")


@pytest.fixture(scope="session")
def folder():
    path = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(path):
        pytest.skip(f"no tables at {path}")
    return path
