"""Incremental load of lake files into the RAW tables, with an audit row per file.

RAW layout: ``<raw>/<table>/generation=G/load_batch=N``. Every micro-batch owns one folder and
overwrites it when it is replayed, so a lost executor or driver never leaves a row twice.
A full reload starts generation G+1 with a new checkpoint; readers see the old one until then.
"""

from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.schemas import LAKE_SCHEMAS, RAW_SCHEMAS, RAW_TABLE_BY_EVENT_TYPE, struct_of
from convoy.sources.lake import committed_numbers, lake_files, lake_path, read_parquet_or_empty

#: No file is too old to be loaded; a backfill may keep the times of its files.
MAX_FILE_AGE = "36500d"
#: A pace for the first load of a large lake, not a limit: all files are loaded.
FILES_PER_BATCH = 10_000

#: Files without a row up to this size are opened by the tasks, larger ones by their footer alone; so many
#: paths at a time.
OPENED_BYTES, PATHS_AT_ONCE = 64 << 20, 1000

GENERATION_SCHEMA = struct_of("generation int")
AUDIT_SCHEMA = struct_of(
    "table_name string, generation int, file_path string, n_rows bigint, load_timestamp timestamp"
)
#: What became of a file that gave no row: ``empty`` or ``unreadable``.
OUTCOME_SCHEMA = struct_of(
    "table_name string, generation int, file_path string, modified_at timestamp, outcome string"
)


def _audit_path(raw: str) -> str:
    return f"{raw}/_load_audit"


def read_load_audit(spark: SparkSession, raw: str) -> DataFrame:
    """One row per loaded file."""
    # A leading underscore hides a folder from readers of its parent, not from this one.
    return read_parquet_or_empty(spark, _audit_path(raw), AUDIT_SCHEMA)


def _outcomes_path(raw: str) -> str:
    return f"{raw}/_load_outcomes"


def read_load_outcomes(spark: SparkSession, raw: str) -> DataFrame:
    """One row per file that gave no row, with the reason, as the load that met it found it."""
    return read_parquet_or_empty(spark, _outcomes_path(raw), OUTCOME_SCHEMA)


def _generations_path(raw: str, table: str) -> str:
    return f"{raw}/_generations/{table}"


def generation_of(spark: SparkSession, raw: str, table: str) -> int:
    """The generation that readers see: the greatest whose load has ended."""
    return max(committed_numbers(spark, _generations_path(raw, table), "ended"), default=0)


def _switch(spark: SparkSession, raw: str, table: str, generation: int) -> None:
    """Make a generation current, also one that no file gave a row."""
    (
        spark.createDataFrame([(generation,)], GENERATION_SCHEMA)
        .write.mode("overwrite")
        .parquet(f"{_generations_path(raw, table)}/ended={generation}")
    )


def read_raw(spark: SparkSession, raw: str, table: str) -> DataFrame:
    """Current content of a RAW table."""
    path = f"{raw}/{table}/generation={generation_of(spark, raw, table)}"
    return read_parquet_or_empty(spark, path, RAW_SCHEMAS[table])


def bind_to_raw(lake_rows: DataFrame, table: str) -> DataFrame:
    """RAW columns by name, case ignored: extra columns are dropped, missing ones are null."""
    present = {c.lower(): c for c in lake_rows.columns}
    columns = []
    for field in RAW_SCHEMAS[table].fields:
        if field.name == "load_timestamp":
            column = F.current_timestamp()
        elif field.name in present:
            column = F.col(present[field.name]).cast(field.dataType)
        else:
            column = F.lit(None).cast(field.dataType)
        columns.append(column.alias(field.name))
    return lake_rows.select(*columns)


def _load_type(
    spark: SparkSession, lake: str, raw: str, event_type: str, generation: int, files_per_batch: int
) -> None:
    table = RAW_TABLE_BY_EVENT_TYPE[event_type]

    def write_batch(rows: DataFrame, batch_id: int) -> None:
        target = f"{raw}/{table}/generation={generation}/load_batch={batch_id}"
        bind_to_raw(rows, table).write.mode("overwrite").parquet(target)
        (
            rows.groupBy("file_path")
            .agg(F.count("*").alias("n_rows"))
            .select(
                F.lit(table).alias("table_name"),
                F.lit(generation).alias("generation"),
                "file_path",
                "n_rows",
                F.current_timestamp().alias("load_timestamp"),
            )
            .write.mode("overwrite")
            .parquet(f"{_audit_path(raw)}/load={table}-{generation}-{batch_id}")
        )

    (
        spark.readStream.schema(LAKE_SCHEMAS[event_type])
        .option("pathGlobFilter", "*.parquet")
        .option("ignoreCorruptFiles", "true")
        .option("maxFileAge", MAX_FILE_AGE)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(lake_path(lake, event_type))
        .select("*", "_metadata.file_path")
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", f"{raw}/_load_checkpoints/{table}/generation={generation}")
        .queryName(f"load_{table}")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def load_events(
    spark: SparkSession,
    lake: str,
    raw: str,
    event_type: str | None = None,
    truncate: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Load the files not seen before, of one type or all, and return the load summary.

    Files of any age are loaded, ``files_per_batch`` at a time. ``truncate`` starts over with every file: a new
    generation is filled and becomes current at the end, empty if the lake is. The summary has, per
    table: files and rows loaded by this call, files of the lake without a row, unreadable
    files, and the rows after it.
    """
    types = [event_type] if event_type else list(RAW_TABLE_BY_EVENT_TYPE)
    started = spark.sql("SELECT unix_micros(now())").first()[0]
    earlier = {} if truncate else _loaded(spark, raw)
    present = [r["event_type"] for r in lake_files(spark, lake).select("event_type").distinct().collect()]
    for name in types:
        table = RAW_TABLE_BY_EVENT_TYPE[name]
        generation = generation_of(spark, raw, table) + (1 if truncate else 0)
        if name in present:
            _load_type(spark, lake, raw, name, generation, files_per_batch)
        if truncate:
            _switch(spark, raw, table, generation)
    _look_into_rowless(spark, lake, raw, types, started)
    return load_summary(spark, lake, raw, types, earlier)


def _current(spark: SparkSession, raw: str) -> DataFrame:
    """Event type, RAW table and the generation readers see: four rows."""
    return spark.createDataFrame(
        [(e, t, generation_of(spark, raw, t)) for e, t in RAW_TABLE_BY_EVENT_TYPE.items()],
        "event_type string, table_name string, generation int",
    )


def _current_audit(spark: SparkSession, raw: str) -> DataFrame:
    return read_load_audit(spark, raw).join(_current(spark, raw), ["table_name", "generation"])


def _loaded(spark: SparkSession, raw: str) -> dict[str, tuple[int, int]]:
    """Files and rows per RAW table: at most four rows reach the driver."""
    totals = (
        _current_audit(spark, raw)
        .groupBy("table_name")
        .agg(F.count("*").alias("n_files"), F.sum("n_rows").alias("n_rows"))
    )
    return {r["table_name"]: (r["n_files"], r["n_rows"]) for r in totals.collect()}


def _plain(path: str) -> Column:
    """The same file can be spelt file:/x in one listing and file:///x in the other."""
    return F.regexp_replace(path, "^[a-z0-9]+:/+", "/")


def _known_files(spark: SparkSession, lake: str, raw: str) -> DataFrame:
    """The listed files with the table they belong to, whether they gave rows, and the outcome if they gave none."""
    files = lake_files(spark, lake).join(_current(spark, raw), "event_type").withColumn("file", _plain("file_path"))
    loaded = _current_audit(spark, raw).select(_plain("file_path").alias("file"), F.lit(True).alias("gave_rows"))
    outcomes = read_load_outcomes(spark, raw).withColumn("file", _plain("file_path"))
    outcomes = outcomes.groupBy("generation", "file", "modified_at").agg(F.max("outcome").alias("outcome"))
    return files.join(loaded.distinct(), "file", "left").join(outcomes, ["generation", "file", "modified_at"], "left")


def _look_into_rowless(spark: SparkSession, lake: str, raw: str, types: list[str], started: int) -> None:
    """Find out why files gave no row, and remember it; each file is opened once.

    Listing and audit tell which files these are, so what is read follows their number, not the lake's size.
    A file with rows that came after the load had ``started`` waits for the next one.
    """
    found = _known_files(spark, lake, raw).filter(F.col("event_type").isin(types))
    new = found.filter("gave_rows is null and outcome is null").select(
        "table_name", "generation", "file_path", "file_size", "modified_at",
        F.unix_micros("modified_at").alias("micros"),
    )
    rows = new.toLocalIterator()
    while part := list(islice(rows, PATHS_AT_ONCE)):
        small = [r.file_path for r in part if r.file_size <= OPENED_BYTES]
        counts = _rows_inside(spark, small) | {
            r.file_path: _rows_by_footer(spark, r.file_path) for r in part if r.file_size > OPENED_BYTES
        }
        outcomes = []
        for r in part:
            n = counts.get(r.file_path)
            if n == 0 or n is None or r.micros < started:
                outcomes.append((*r[:3], r.modified_at, "empty" if n == 0 else "unreadable"))
        if outcomes:
            spark.createDataFrame(outcomes, OUTCOME_SCHEMA).write.mode("append").parquet(_outcomes_path(raw))


def _rows_inside(spark: SparkSession, paths: list[str]) -> dict[str, int | None]:
    """Rows of each file by its footer, None if it is no Parquet file."""
    if not paths:
        return {}
    files = spark.read.format("binaryFile").load(paths).filter(F.col("length") <= OPENED_BYTES)
    found = files.select("path", "content").mapInArrow(_footers, "path string, n_rows bigint").collect()
    plain = {r.path.split(":", 1)[-1].lstrip("/"): r.n_rows for r in found}
    return {p: plain.get(p.split(":", 1)[-1].lstrip("/")) for p in paths}


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = []
        for content in batch.column("content"):
            try:
                counts.append(pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata.num_rows)
            except (pa.ArrowInvalid, OSError):
                counts.append(None)
        columns = [batch.column("path"), pa.array(counts, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["path", "n_rows"])


def _rows_by_footer(spark: SparkSession, path: str) -> int | None:
    """Rows of one large file: a count without columns reads its footer only."""
    try:
        return spark.read.option("ignoreCorruptFiles", "false").parquet(path).count()
    except (PySparkException, Py4JError):
        return None


def load_summary(
    spark: SparkSession,
    lake: str,
    raw: str,
    types: list[str],
    earlier: dict[str, tuple[int, int]],
) -> DataFrame:
    """Per table what a load did, from the listing, the audit and the outcomes: no file is opened."""
    totals = _current_audit(spark, raw).groupBy("table_name").agg(
        F.count("*").alias("files_after"), F.sum("n_rows").alias("n_rows_after")
    )
    rowless = (
        _known_files(spark, lake, raw)
        .filter("gave_rows is null")
        .groupBy("event_type")
        .agg(
            F.count_if(F.col("outcome") == "empty").alias("n_empty"),
            F.count_if(F.col("outcome") == "unreadable").alias("n_errors"),
        )
    )
    tables = spark.createDataFrame(
        [(t, RAW_TABLE_BY_EVENT_TYPE[t], *earlier.get(RAW_TABLE_BY_EVENT_TYPE[t], (0, 0))) for t in types],
        "event_type string, table_name string, files_before bigint, rows_before bigint",
    )
    return (
        tables.join(totals, "table_name", "left")
        .join(rowless, "event_type", "left")
        .fillna(0)
        .select(
            "table_name",
            (F.col("files_after") - F.col("files_before")).alias("n_files"),
            (F.col("n_rows_after") - F.col("rows_before")).alias("n_loaded"),
            "n_empty",
            "n_errors",
            "n_rows_after",
        )
    )
