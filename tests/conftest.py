import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lodgelake.session import SCALE_CONFS
    ckpt = tempfile.mkdtemp(prefix="lodgelake-test-ckpt-")
    b = (SparkSession.builder.master("local[4]").appName("lodgelake-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", ckpt))
    for k, v in SCALE_CONFS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.setCheckpointDir(ckpt)
    yield s
    s.stop()
