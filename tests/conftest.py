import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from millrace.session import REQUIRED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("millrace-tests")
    settings = {
        **REQUIRED,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small hand-made frames: frame(rows, ddl)."""
    return spark.createDataFrame


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, for comparing without order."""

    def collected(df):
        return sorted((tuple(row) for row in df.collect()), key=repr)

    return collected
