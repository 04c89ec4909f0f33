import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")  # Python workers import the package too


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    s = builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.warehouse.dir", tempfile.mkdtemp()).config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp()).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
