import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session

    s = build_session("local[*]", app="tidemark-tests", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-tests-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_lake(spark):
    from tidemark.session import scratch_path

    return scratch_path(spark, "test")
