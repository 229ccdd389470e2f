import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from dimloom.session import get_session

    chk = tempfile.mkdtemp(prefix="dimloom-test-chk-")
    s = get_session(master="local[4]", shuffle_partitions=4, checkpoint_dir=chk)
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="dimloom-test-")
