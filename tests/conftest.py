import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratum.session import get_session, checkpoint_dir
    s = get_session("local[4]", 8)
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL
