import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sparkrank.session import local_session

    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()
