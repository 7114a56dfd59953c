import os

import pytest

from listforge.session import build_session


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    s = build_session("tests", master="local[8]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
