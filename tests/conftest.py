import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tillcast.session import SESSION_DEFAULTS, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[4]").appName("tillcast-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillcast-test-ckpt-")))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()
