import pytest

from pressmill.session import local_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4)


@pytest.fixture(scope="session")
def folder():
    return SMALL
