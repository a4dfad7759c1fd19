import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from tramline.session import REQUIRED_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("tramline-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tramline-wh-", dir="/tmp")))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch():
    """A fresh folder for one test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="tramline-test-", dir="/tmp")
