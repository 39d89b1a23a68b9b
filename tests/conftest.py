import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import check  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return check.session()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con():
    return check.connect(SF)
