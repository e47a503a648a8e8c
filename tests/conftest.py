import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from footfall.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="footfall-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="footfall-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="footfall-test-")
