"""Intermediate tables of the operators, and the input tables of the queries."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.session import work_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back: fixes generated ids,
    cuts the lineage and survives lost executors."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.stored_path = path
    return found


def discard(*tables: DataFrame) -> None:
    """Remove stored tables whose rows nothing will read any more."""
    for found in tables:
        spark = found.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(found.stored_path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z only in lower case. Pure ASCII takes the fast path."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower())
    )

