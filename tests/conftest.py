import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kinrank.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="kinrank-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="kinrank-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from kinrank.plans.compare import duck_connect
    return duck_connect(SF_SMALL)
