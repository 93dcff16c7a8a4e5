import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from recurra.session import build_session

    ckpt = tempfile.mkdtemp(prefix="recurra-test-ckpt-")
    s = build_session("local[*]", 8, app="recurra-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    from tests.compare import duck as _duck

    return _duck(SF_SMALL)
