import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tally.session import get_session

    s = get_session("local[4]", app="tally-tests", shuffle_partitions=8)
    yield s
    s.stop()


SMOKE = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
