import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def one(spark):
    """The value of an expression over one row of columns."""

    def run(make, **values):
        names = list(values)
        kinds = ", ".join(f"{n} {'binary' if isinstance(v, bytes) else 'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for n, v in values.items())
        return spark.createDataFrame([tuple(values.values())], kinds).select(make(*names).alias("out")).first().out

    return run
