import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", shuffle_partitions=4, app="tests")


def rows(df):
    """All rows as sorted tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
