import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vatlens.session import build_session
    scratch = tempfile.mkdtemp(prefix="vatlens-test-")
    # the checkpoint folder comes from the session when configured, else a private one
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.local.dir": scratch})
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="vatlens-case-")
