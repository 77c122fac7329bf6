import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from newsflow.session import build_session
    s = build_session("local[4]", app="newsflow-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):      # only where the platform sets none
        ckpt = tempfile.mkdtemp(prefix="newsflow-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", ckpt)
        s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(spark):
    from newsflow.session import scratch_path
    return scratch_path(spark, "test")
