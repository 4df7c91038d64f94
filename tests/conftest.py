import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("maskfold-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # a shared folder for lineage cuts; only set when the session has none, as on a cluster
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        d = tempfile.mkdtemp(prefix="maskfold-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="maskfold-out-")
