import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tallybook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tallybook-test-")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
