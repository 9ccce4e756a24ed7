import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerline.session import SESSION_DEFAULTS, ensure_checkpoint_dir

    builder = SparkSession.builder.master("local[*]").appName("ledgerline-tests")
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
