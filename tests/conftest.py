import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyfold.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {}
    # tests name their own shared folder only when the session has none
    if not os.environ.get("SKYFOLD_KEEP_CKPT"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="skyfold-test-")
    s = build_session(app="skyfold-tests", master="local[4]", shuffle_partitions=4,
                      extra=extra)
    yield s


@pytest.fixture
def tmp_root(spark):
    from skyfold.session import workspace
    return workspace(spark, "test")
