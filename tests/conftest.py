import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from changelake.session import build_session
    ck = tempfile.mkdtemp(prefix="changelake-test-ck-")
    s = build_session("local[4]", app_name="changelake-tests", shuffle_partitions=4,
                      extra_conf={"spark.checkpoint.dir": ck})
    yield s
    s.stop()


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)
