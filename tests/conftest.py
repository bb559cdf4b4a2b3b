import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from kestrel.session import get_session, scratch_dir
    s = get_session("local[4]", 4)
    scratch_dir(s)  # the session's spark.checkpoint.dir, or a local folder only when unset
    yield s
