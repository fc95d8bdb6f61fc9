import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from viewstar.session import get_session
    ckpt = tempfile.mkdtemp(prefix="viewstar-test-ckpt-")
    s = get_session("local[8]", 8, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
