"""Compacted days of the lake, and which folders they stand for.

A stream leaves a folder per writer and batch. Compaction writes the rows of a day into a *run* of few files and
then commits a new version of the manifest: one small file that names the runs in use and the folders
they replace. Readers take the newest version when they are built, so they see either the folders or the
run, never both and never a part. Folders that come later are not named and are read beside the runs. What is
replaced stays on disk until ``vacuum``, for readers that began before.

One maintainer at a time: a second one that commits the same version fails.
"""

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.schemas import LAKE_SCHEMAS, STORED_EVENTS
from convoy.sources.lake import (
    file_system,
    folder_values,
    lake_files,
    lake_path,
    read_parquet_or_empty,
    remove_folder,
    write_file,
)

#: How the folder of unknown days is called.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Manifest:
    """``runs``: the run that holds each compacted day. ``replaced``: folders (day/writer/batch) not to be read."""

    version: int = 0
    runs: dict[str, str] = field(default_factory=dict)
    replaced: list[str] = field(default_factory=list)


def _manifest_path(root: str, event_type: str) -> str:
    return f"{root.rstrip('/')}/manifest/{event_type}"


def _runs_path(root: str, event_type: str) -> str:
    return f"{root.rstrip('/')}/compacted/{event_type}"


def read_manifest(spark: SparkSession, root: str, event_type: str) -> Manifest:
    """The newest version; an empty one if nothing was ever compacted."""
    path = _manifest_path(root, event_type)
    versions = sorted(int(v) for v in folder_values(spark, path, "version"))
    if not versions:
        return Manifest()
    lines = spark.read.text(f"{path}/version={versions[-1]}", wholetext=True).first()[0]
    return Manifest(versions[-1], **json.loads(lines))


def _commit(spark: SparkSession, root: str, event_type: str, after: Manifest) -> None:
    path = f"{_manifest_path(root, event_type)}/version={after.version}"
    files, place = file_system(spark, path)
    if files.exists(place):
        raise RuntimeError(f"another maintainer has written version {after.version} of {event_type}")
    write_file(spark, path, json.dumps({"runs": after.runs, "replaced": after.replaced}).encode())


def _day() -> Column:
    return F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DAY))


def _folder() -> Column:
    """The folder a stored row lies in, from its partition columns alone, so whole folders are skipped."""
    return F.concat_ws("/", _day(), "writer_id", "batch_id")


def stored_in(spark: SparkSession, root: str, event_type: str, folders: list[str]) -> DataFrame:
    """Rows of the named folders."""
    rows = read_parquet_or_empty(spark, lake_path(root, event_type), STORED_EVENTS[event_type])
    return rows.filter(_folder().isin(folders))


def compacted_in(spark: SparkSession, root: str, event_type: str, runs: dict[str, str]) -> DataFrame:
    """Rows of compacted days."""
    rows = spark.createDataFrame([], LAKE_SCHEMAS[event_type])
    for run in sorted(set(runs.values())):
        days = [d for d, r in runs.items() if r == run]
        own = spark.read.schema(LAKE_SCHEMAS[event_type]).parquet(f"{_runs_path(root, event_type)}/run={run}")
        rows = rows.unionByName(own.filter(_day().isin(days)))
    return rows


def read_stored(spark: SparkSession, root: str, event_type: str) -> DataFrame:
    """Lake rows with ``writer_id`` and ``batch_id``, which are null in compacted days."""
    at = read_manifest(spark, root, event_type)
    rows = read_parquet_or_empty(spark, lake_path(root, event_type), STORED_EVENTS[event_type])
    if at.replaced:
        rows = rows.filter(~_folder().isin(at.replaced))
    if at.runs:
        rows = rows.unionByName(compacted_in(spark, root, event_type, at.runs), allowMissingColumns=True)
    return rows


def read_lake(spark: SparkSession, root: str, event_type: str) -> DataFrame:
    """All rows of one event type, compacted or not."""
    return read_stored(spark, root, event_type).select(*LAKE_SCHEMAS[event_type].names)


def live_folders(spark: SparkSession, root: str, event_type: str, at: Manifest) -> dict[str, list[str]]:
    """Folders that readers see, by day: names only, from the listing."""
    parts = [F.regexp_extract("file_path", f"/{name}=([^/]+)/", 1) for name in ("event_date", "writer_id", "batch_id")]
    files = lake_files(spark, root).filter(F.col("event_type") == event_type)
    names = files.select(*[p.alias(n) for p, n in zip(parts, ("day", "writer", "batch"))]).filter("batch <> ''").distinct()
    hidden, found = set(at.replaced), {}
    for day, writer, batch in sorted(names.collect()):
        if (folder := f"{day}/{writer}/{batch}") not in hidden:
            found.setdefault(day, []).append(folder)
    return found


def switch_days(
    spark: SparkSession, root: str, event_type: str, rows: DataFrame, days: set[str], folders: list[str], at: Manifest
) -> Manifest:
    """Make ``rows`` the content of ``days`` in place of ``folders`` and of the runs that held them."""
    run = uuid.uuid4().hex[:12]
    path = f"{_runs_path(root, event_type)}/run={run}"
    wanted = rows.select(*LAKE_SCHEMAS[event_type].names).hint("rebalance", "event_date")
    wanted.write.partitionBy("event_date", "event_type").parquet(path)
    written = set(folder_values(spark, path, "event_date"))
    runs = {d: r for d, r in at.runs.items() if d not in days} | {d: run for d in days & written}
    after = Manifest(at.version + 1, runs, at.replaced + folders)
    _commit(spark, root, event_type, after)
    return after


def compact(spark: SparkSession, root: str, event_type: str, before: str | None = None, at_least: int = 2) -> list[str]:
    """Put the folders of each day into one run; days with ``at_least`` folders, only those ``before`` an ISO day
    if given. Returns the days. Rows that arrive meanwhile stay in their own folders."""
    at = read_manifest(spark, root, event_type)
    folders = live_folders(spark, root, event_type, at)
    due = {d: f for d, f in folders.items() if len(f) >= at_least and (before is None or d < before)}
    if not due:
        return []
    names = [f for own in due.values() for f in own]
    rows = stored_in(spark, root, event_type, names).drop("writer_id", "batch_id")
    rows = rows.unionByName(compacted_in(spark, root, event_type, {d: r for d, r in at.runs.items() if d in due}))
    switch_days(spark, root, event_type, rows, set(due), names, at)
    return sorted(due)


def vacuum(spark: SparkSession, root: str, event_type: str, loaded: DataFrame | None = None) -> int:
    """Remove replaced folders, and runs that no day uses; returns the number of folders removed.

    Call it when no reader is left that began before the last compaction. With ``loaded`` (the load audit: column
    ``file_path``) folders stay as long as one of their files was not loaded into RAW.
    """
    at = read_manifest(spark, root, event_type)
    waiting: set[str] = set()
    if loaded is not None:
        plain = F.regexp_replace("file_path", "^[a-z0-9]+:/+", "/")
        files = lake_files(spark, root).filter(F.col("event_type") == event_type).select(plain.alias("file"))
        left = files.join(loaded.select(plain.alias("file")), "file", "left_anti")
        parts = [F.regexp_extract("file", f"/{name}=([^/]+)/", 1) for name in ("event_date", "writer_id", "batch_id")]
        waiting = {r[0] for r in left.select(F.concat_ws("/", *parts)).distinct().collect()}
    gone = [f for f in at.replaced if f not in waiting]
    for folder in gone:
        day, writer, batch = folder.split("/")
        inner = f"event_date={day}/event_type={event_type}/writer_id={writer}/batch_id={batch}"
        remove_folder(spark, f"{lake_path(root, event_type)}/{inner}")
    if gone:
        _commit(spark, root, event_type, Manifest(at.version + 1, at.runs, [f for f in at.replaced if f in waiting]))
    for run in folder_values(spark, _runs_path(root, event_type), "run"):
        if run not in at.runs.values():
            remove_folder(spark, f"{_runs_path(root, event_type)}/run={run}")
    return len(gone)
