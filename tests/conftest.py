from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import get_session
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g"})
    # tests own their shared folder unless the session already names one
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="ledgerline-test-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def scratch(spark):
    from ledgerline.session import shared_dir
    return shared_dir(spark, "test")
