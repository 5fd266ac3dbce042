import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Small partitions stay apart, so that tests see several slices.
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def bronze_rows(spark):
    """Bronze rows out of (source, timestamp, price text, user) tuples."""
    from ledgerlake.operators.clean import to_bronze

    def make(rows):
        raw = spark.createDataFrame(rows, "source_file string, timestamp string, price string, user_id string")
        return to_bronze(raw)

    return make
