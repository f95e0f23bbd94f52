import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from quern.session import local_session
    s = local_session("*", 8, app="quern-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quern-test-ckpt-")})
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"
