import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from ledgerline.session import SESSION_DEFAULTS, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = (b.config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
         .config("spark.driver.memory", "4g").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="ledgerline-test-")
