import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickforge.session import build_session
    s = build_session("local[4]", app="tickforge-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def fresh_dir(spark):
    """A new folder under the session's shared scratch area."""
    from tickforge.session import run_dir
    return run_dir(spark, "test")
