import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gridcast.session import get_session

    s = get_session("local[4]", 4, app="gridcast-tests")
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
