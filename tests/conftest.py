import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from txnlake.session import get_session
    ckpt = tempfile.mkdtemp(prefix="txnlake-test-ckpt-")
    s = get_session("local[4]", app_name="txnlake-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SMALL
