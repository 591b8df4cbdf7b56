import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from daycast.session import get_session
    ckpt = tempfile.mkdtemp(prefix="daycast-test-ckpt-")
    s = get_session("local[4]", app="daycast-tests", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()
