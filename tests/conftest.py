import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest  # noqa: E402

import rostrum  # noqa: E402,F401


@pytest.fixture(scope="session")
def spark():
    from rostrum.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, app="rostrum-tests")
    yield s
    s.stop()
