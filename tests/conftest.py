import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from velomart.session import build_session

    session = build_session("local[*]", app_name="velomart-tests", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    from velomart.session import scratch_path

    counter = {"n": 0}

    def make(name="t"):
        counter["n"] += 1
        return scratch_path(spark, f"{name}{counter['n']}")

    return make
