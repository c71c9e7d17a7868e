import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickbars.session import build_session, ship_package

    extra = {}
    if not os.environ.get("SPARK_CHECKPOINT_DIR_SET"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tickbars-test-")
    s = build_session("local[4]", app="tickbars-tests", shuffle_partitions=8, extra=extra)
    ship_package(s)
    yield s
    s.stop()
