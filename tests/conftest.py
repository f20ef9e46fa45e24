import sys
from pathlib import Path

import pytest
from pyspark import SparkConf
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[2]").appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if not SparkConf().get("spark.checkpoint.dir", None):
        builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Build a text table from rows of values."""
    def make(columns, rows):
        return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{c} string" for c in columns.split()))

    return make
