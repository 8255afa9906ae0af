import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import get_session

    s = get_session(master="local[4]", partitions=4, app="feedloom-tests")
    yield s


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]
