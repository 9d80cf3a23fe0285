import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sectora.session import local_session

    s = local_session("*", shuffle_partitions=8, app="sectora-tests")
    yield s
    s.stop()
