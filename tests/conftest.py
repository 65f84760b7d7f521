import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = os.environ.get("TEXTLAB_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from textlab.session import checkpoint_dir, local_session
    s = local_session(shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    from tools.oracle_check import duck_connect
    return duck_connect(sf_dir)
