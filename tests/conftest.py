import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedback_lens.session import tuned  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
    session = tuned(builder).config("spark.ui.enabled", "false").config("spark.driver.memory", "6g").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
