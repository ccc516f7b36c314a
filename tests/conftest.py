import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ventilake.session import build_session

    # tests only: a folder of this machine, which a local session shares with itself
    folder = tempfile.mkdtemp(prefix="ventilake-test-ckpt-")
    s = build_session("local[4]", app="ventilake-tests", shuffle_partitions=4, **{"spark.checkpoint.dir": folder})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="ventilake-test-")
