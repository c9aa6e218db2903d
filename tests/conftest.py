import itertools
import tempfile

import pytest

from gridcast.session import configure, local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return configure(local_session(8, app="tests", memory="8g"))


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def _root():
    return tempfile.mkdtemp(prefix="gridcast-tests-")


@pytest.fixture
def fresh(_root, request):
    """Fresh paths below one folder per test session."""
    numbers = itertools.count()
    return lambda: f"{_root}/{request.node.name.replace('[', '-').replace(']', '')}-{next(numbers)}"
