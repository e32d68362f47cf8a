import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))
sys.path.insert(0, HERE)


@pytest.fixture(scope="session")
def spark():
    from marquee.session import get_session
    s = get_session("local[*]", app="marquee-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
