import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from lodeflow.session import prepare

    s = SparkSession.builder.master(f"local[{os.environ.get('TEST_CPUS', '4')}]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield prepare(s)
    s.stop()
