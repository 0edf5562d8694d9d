"""Topic streams: reading the envelope, decoding the payload."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.schemas import ENVELOPE_SCHEMA, topic_schema


def read_topic(
    spark: SparkSession, topic: str, servers: str, max_offsets_per_trigger: int | None = None
) -> DataFrame:
    """Stream of a topic's records (needs the Kafka connector on the class path).

    ``max_offsets_per_trigger`` bounds a micro-batch, and with it what one task can meet when the
    stream catches up after a stop.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def read_topic_files(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same stream from Parquet files that hold topic records."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parse_events(records: DataFrame, topic: str) -> DataFrame:
    """Record key and arrival time, then the payload's fields.

    A payload that is no JSON, or a field of the wrong type, becomes null.
    """
    payload = F.from_json(F.col("value").cast("string"), topic_schema(topic))
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("timestamp").alias("kafka_timestamp"),
        # As a one-element array rather than ``payload.*``: later filters are not pushed below
        # a generator, where they would parse the text once more for every field they test.
        F.inline(F.array(payload)),
    )
