"""The Parquet lake: one folder per event type, partitioned by event_date and event_type."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.schemas import EVENT_TYPES


def lake_path(root: str, event_type: str) -> str:
    return f"{root.rstrip('/')}/events/{event_type}"


def dead_letter_path(root: str) -> str:
    return f"{root.rstrip('/')}/dead_letter"


def read_parquet_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet rows bound to ``schema`` by column name, case ignored; no rows if nothing is there.

    The schema is given, so no file is opened to infer one.
    """
    try:
        rows = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], schema)
    return rows.select(*schema.names)


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def file_exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether a table's folder was written to the end."""
    return file_exists(spark, f"{path}/_SUCCESS")


def folder_values(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values of the folders ``name=value`` directly below a path, none if it is not there."""
    files, place = file_system(spark, path)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, f"{name}=*")) or []
    return sorted(status.getPath().getName().split("=", 1)[1] for status in found)


def committed_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``name=number`` below a path that were written to the end, rising."""
    return sorted(int(v) for v in folder_values(spark, path, name) if is_committed(spark, f"{path}/{name}={v}"))


def remove_folder(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def write_file(spark: SparkSession, path: str, content: bytes) -> None:
    """A small file beside the tables, complete or not there: it gets its name when it is written."""
    files, place = file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f"_{place.getName()}.draft")
    out = files.create(draft, True)
    out.write(bytearray(content))
    out.close()
    files.rename(draft, place)


def publish_folder(spark: SparkSession, source: str, target: str) -> None:
    """Let a folder of rows that is complete appear at ``target``, marked as written to the end."""
    files, place = file_system(spark, target)
    files.mkdirs(place.getParent())
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place):
        raise OSError(f"{source} could not become {target}")
    write_file(spark, f"{target}/_SUCCESS", b"")


_EVENT_TYPE = "regexp_extract(path, '/events/([^/]+)/', 1) AS event_type"


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """Event type, path, size and time of every Parquet file, from the listing: no content is read."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet")
            .option("recursiveFileLookup", "true")
            .load(lake_path(root, ""))
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return files.selectExpr(
        _EVENT_TYPE, "path AS file_path", "length AS file_size", "modificationTime AS modified_at"
    )


def file_inventory(spark: SparkSession, root: str, event_type: str | None = None) -> DataFrame:
    """Number of files and bytes per event type, 0 where there are none."""
    wanted = [event_type] if event_type else EVENT_TYPES
    counted = (
        lake_files(spark, root)
        .groupBy("event_type")
        .agg(F.count("*").alias("n_files"), F.sum("file_size").alias("n_bytes"))
    )
    labels = spark.createDataFrame([(t,) for t in wanted], "event_type string")
    return labels.join(counted, "event_type", "left").fillna(0)
