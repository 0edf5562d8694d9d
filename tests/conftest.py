import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """DataFrame from a schema text and tuples; ISO texts fill timestamp columns."""

    def make(schema, *rows):
        texts = schema.replace("timestamp_ntz", "string").replace(" timestamp,", " string,")
        if texts.endswith(" timestamp"):
            texts = texts[: -len("timestamp")] + "string"
        df = spark.createDataFrame(list(rows), texts)
        for column in schema.split(","):
            name, kind = column.split()
            if kind.startswith("timestamp"):
                df = df.withColumn(name, df[name].cast(kind))
        return df

    return make


@pytest.fixture
def at():
    return datetime.fromisoformat
