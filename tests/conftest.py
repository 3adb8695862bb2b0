import sys

import pytest

sys.path.insert(0, "/root/repo")


def make_session():
    from tabwright.sources.session import local_session

    return local_session(8, "tabwright-tests")


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.01"
