import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")
sys.path.insert(0, ROOT)
FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", str(base / "checkpoint"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def column(spark):
    """Apply a column expression to literal texts."""
    def apply(expression, values, kind="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
        return [r["y"] for r in frame.select("i", expression(frame["x"]).alias("y")).orderBy("i").collect()]

    return apply
