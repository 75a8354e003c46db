import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from lendwise.session import LOCAL_CONF, checkpoint_dir
    b = SparkSession.builder.master("local[4]").appName("lendwise-tests") \
        .config("spark.sql.shuffle.partitions", "4")
    for k, v in LOCAL_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF001
