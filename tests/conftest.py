import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from skyops.session import prepare

    s = (SparkSession.builder.master("local[8]").appName("skyops-tests")
         .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "8g")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield prepare(s)
    s.stop()
