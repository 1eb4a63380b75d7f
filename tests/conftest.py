import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("appendlog-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    from appendlog.session import ship_package

    ship_package(s)
    yield s


@pytest.fixture
def tmp(tmp_path_factory):
    # a new folder per test (tests only: a cluster uses spark.checkpoint.dir)
    return tempfile.mkdtemp(prefix="appendlog-test-", dir=str(tmp_path_factory.getbasetemp()))
