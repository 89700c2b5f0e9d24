import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from skilltrends.session import build_session
    s = build_session("local[4]", app="skilltrends-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        # tests only: a local scratch folder when the session names none
        s.sparkContext.setCheckpointDir(
            s.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="st-ckpt-"))
    yield s
    s.stop()
