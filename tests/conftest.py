import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from erascore.session import local_session

    s = local_session("*", 8, app="erascore-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL
