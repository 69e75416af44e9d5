import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tunewright.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=4, memory="6g", shuffle=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def as_rows():
    return rows
