import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cityflow.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = get_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": shared,
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def message(spark):
    """Messages from ``(data, attributes, publish time text)`` rows."""
    from pyspark.sql import functions as F

    from cityflow import schemas

    def build(*rows):
        text = spark.createDataFrame(
            [(None if d is None else bytearray(d.encode()), a, t) for d, a, t in rows],
            "data BINARY, attributes MAP<STRING,STRING>, t STRING",
        )
        out = text.select("data", "attributes", F.col("t").cast("timestamp").alias("publish_time"))
        assert out.schema.simpleString() == spark.createDataFrame(
            [], schemas.MESSAGE
        ).schema.simpleString()
        return out

    return build
