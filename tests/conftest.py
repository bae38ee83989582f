import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sluice.session import checkpoint_dir, get_session

    s = get_session("local[4]", app="sluice-tests", shuffle_partitions=8,
                    extra={"spark.ui.enabled": "false"})
    s.sparkContext.setLogLevel("ERROR")
    # tests only: install a checkpoint dir when the session has none
    checkpoint_dir(s, default=tempfile.mkdtemp(prefix="sluice-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture
def outdir(spark):
    from sluice.plans.tables import scratch_path

    return scratch_path(spark, "test")
