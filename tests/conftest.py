import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.driver.memory": "4g", "spark.log.level": "ERROR"}
    session = SparkSession.builder.master("local[8]").config(map=conf).getOrCreate()
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
