import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meterlake.session import build_session
    ck = tempfile.mkdtemp(prefix="meterlake-test-")
    s = build_session("local[4]", 8, app_name="meterlake-tests",
                      extra={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="meterlake-case-")
