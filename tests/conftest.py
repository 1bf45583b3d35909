import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lectern.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="lectern-test-")
    session = local_session("4", shuffle_partitions=4, memory="4g", warehouse=warehouse)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder():
    """A fresh folder; it is left behind."""
    return tempfile.mkdtemp(prefix="lectern-test-")
