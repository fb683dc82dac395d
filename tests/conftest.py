import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[*]").appName("quarry-tests")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.adaptive.enabled", "true")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from quarry.session import checkpoint_dir
    # tests set their own checkpoint folder only where the session names none
    checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="quarry-ckpt-"))
    yield spark


@pytest.fixture(scope="session")
def sf():
    return SF_SMALL


@pytest.fixture(scope="session")
def duck():
    from tools.oracle_check import duck_connect
    return duck_connect(SF_SMALL)
