import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate a Column function over a list of strings, in input order."""
    from pyspark.sql import functions as F

    def run(expression, values):
        rows = [(i, value) for i, value in enumerate(values)]
        frame = spark.createDataFrame(rows, "i int, v string").repartition(3)
        found = frame.select("i", expression(F.col("v")).alias("r")).collect()
        return [row.r for row in sorted(found, key=lambda row: row.i)]

    return run
