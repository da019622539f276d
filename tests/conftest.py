import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .appName("varlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # tests set their own checkpoint folder only because none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF0001
