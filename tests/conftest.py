import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tabwright.session import local_session

    session = local_session("tests", 8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows as plain tuples, in order."""
    return lambda df: [tuple(r) for r in df.collect()]
