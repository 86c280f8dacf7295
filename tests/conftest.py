import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from pitchside.session import DEFAULT_CONF

    builder = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder (a cluster names a shared one)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pitchside-test-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def star_small(spark):
    from pitchside.plans.pipeline import star_session
    return star_session(spark, SF0001)
