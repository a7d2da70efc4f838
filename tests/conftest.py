import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orderlake.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def tmp_root(spark):
    from orderlake.session import scratch_dir
    return scratch_dir(spark, "test")
