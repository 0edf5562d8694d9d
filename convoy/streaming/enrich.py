"""GPS enrichment of a stream: the last position of every vehicle crosses batch boundaries."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.plans.enrich import (
    add_anomaly_flags,
    enrich_gps,
    with_movement,
    with_previous_position,
)
from convoy.plans.ingest import with_lake_columns
from convoy.schemas import struct_of
from convoy.sources import manifest
from convoy.streaming.state import BatchState

METRICS = [
    "prev_lat", "prev_lon", "prev_event_time", "distance_km", "elapsed_seconds", "computed_speed_kmh", "is_immobile",
]

LAST_POSITION = struct_of(
    "vehicle_id string, lat double, lon double, event_time timestamp"
)


def last_positions(path: str) -> BatchState:
    return BatchState(path, LAST_POSITION)


def enrich_batch(batch: DataFrame, last: DataFrame | None = None) -> DataFrame:
    """Enrich one micro-batch.

    Without ``last`` the first position of a vehicle in the batch has no predecessor. With it, the
    vehicle's last known position takes part as one more row. A late position, older than that
    row, sorts before it: it never becomes the predecessor of a newer one, and has itself
    only late positions of its own batch to follow.
    """
    if last is None:
        return enrich_gps(batch)
    known = last.withColumn("_new", F.lit(False))
    rows = known.unionByName(batch.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    # Equal times: the known position first, then the batch in its own order.
    first = ["vehicle_id", "event_time", "_new"]
    ordered = rows.select(*first, *[c for c in batch.columns if c not in first])
    return (
        ordered.transform(with_previous_position)
        .filter("_new")
        .transform(with_movement)
        .transform(add_anomaly_flags)
        .select(*batch.columns, *METRICS, "anomaly_types", "is_anomaly")
    )


def advance(last: DataFrame, batch: DataFrame) -> DataFrame:
    """Last position per vehicle after a batch, one row per vehicle ever seen."""
    order = ["event_time", *[c for c in ["kafka_timestamp"] if c in batch.columns]]
    order += [c for c in batch.columns if c not in order and c != "vehicle_id"]
    seen = (
        last.withColumn("_new", F.lit(False))
        .unionByName(batch.withColumn("_new", F.lit(True)), allowMissingColumns=True)
        .filter("event_time is not null")
    )
    newest = F.max(F.struct("event_time", "_new", *order[1:])).alias("newest")
    return (
        seen.groupBy("vehicle_id")
        .agg(newest)
        .select("vehicle_id", "newest.lat", "newest.lon", "newest.event_time")
    )


def mend_lake(spark: SparkSession, lake: str, since: date) -> None:
    """Enrich the lake's positions from the day ``since`` on anew, as one pass over the whole history gives them.

    Late positions have found their predecessors in their own batch only, and the positions that follow them don't
    know them. The last position of every vehicle before ``since`` takes part. The days are written to a new run and
    switched at once, so readers see them as they were or mended; what streams write meanwhile stays beside
    them until the next call.
    """
    at = manifest.read_manifest(spark, lake, "gps")
    folders = manifest.live_folders(spark, lake, "gps", at)
    due = {d for d in {*folders, *at.runs} if d != manifest.NO_DAY and d >= since.isoformat()}
    names = [f for d, own in folders.items() if d in due for f in own]
    before = [f for d, own in folders.items() if d not in due for f in own]
    derived = [*METRICS, "anomaly_types", "is_anomaly", "event_date", "event_type"]

    def rows(chosen: list[str], runs: dict[str, str]) -> DataFrame:
        stored = manifest.stored_in(spark, lake, "gps", chosen).drop("writer_id", "batch_id")
        return stored.unionByName(manifest.compacted_in(spark, lake, "gps", runs)).drop(*derived)

    positions = rows(names, {d: r for d, r in at.runs.items() if d in due})
    earlier = rows(before, {d: r for d, r in at.runs.items() if d not in due})
    none = spark.createDataFrame([], LAST_POSITION)
    mended = with_lake_columns(enrich_batch(positions, advance(none, earlier)), "gps")
    manifest.switch_days(spark, lake, "gps", mended, due, names, at)
