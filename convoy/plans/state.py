"""Current state of every vehicle."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.schemas import STATE_TTL_SECONDS

STATE_FIELDS = ["driver_id", "lat", "lon", "speed_kmh", "event_time"]


def vehicle_state(positions: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Latest position per vehicle. A maximum, so a busy vehicle is reduced on the map side.

    ``updated_at`` is the time of writing that the time-to-live counts from; the time of
    the position itself unless given.
    """
    rest = [c for c in STATE_FIELDS if c != "event_time"]
    written = F.col("event_time") if updated_at is None else updated_at
    newest = F.max(F.struct("event_time", *rest, written.alias("updated_at")))
    return (
        positions.groupBy("vehicle_id")
        .agg(newest.alias("newest"))
        .select("vehicle_id", *[f"newest.{c}" for c in [*STATE_FIELDS, "updated_at"]])
    )


def merge_state(rows: DataFrame) -> DataFrame:
    """Newest position per vehicle of several states; the time of writing of the newest write is kept."""
    fields = F.struct("event_time", *[c for c in STATE_FIELDS if c != "event_time"])
    return (
        rows.groupBy("vehicle_id")
        .agg(F.max(fields).alias("newest"), F.max("updated_at").alias("updated_at"))
        .select("vehicle_id", *[f"newest.{c}" for c in STATE_FIELDS], "updated_at")
    )


def live_state(state: DataFrame, as_of: Column, ttl_seconds: int = STATE_TTL_SECONDS) -> DataFrame:
    """Vehicles heard of within the time-to-live."""
    age = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(
        F.col("updated_at").cast("timestamp")
    )
    return state.filter(age < ttl_seconds * 1_000_000)


def lookup_vehicle(state: DataFrame, vehicle_id: str) -> DataFrame:
    """One vehicle's state; no row when it is not tracked."""
    return state.filter(F.col("vehicle_id") == vehicle_id)


def tracked_vehicles(state: DataFrame) -> DataFrame:
    return state.select("vehicle_id").distinct()


def encode_state(state: DataFrame) -> DataFrame:
    """The state as a text hash: unknown fields are empty strings, times ISO-8601."""
    time = F.col("event_time").cast("timestamp")
    iso = F.concat(
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(F.unix_micros(time) % 1_000_000 == 0, "").otherwise(
            F.date_format(time, ".SSSSSS")
        ),
    )
    texts = {c: F.col(c).cast("string") for c in STATE_FIELDS if c != "event_time"}
    texts["event_time"] = iso
    return state.select(
        F.format_string("vehicle:%s:state", "vehicle_id").alias("key"),
        *[F.coalesce(text, F.lit("")).alias(name) for name, text in texts.items()],
    )


def decode_state(hashes: DataFrame) -> DataFrame:
    """Typed state from text hashes; empty or unreadable fields are null."""
    number = {c: F.col(c).try_cast("double") for c in ["lat", "lon", "speed_kmh"]}
    return hashes.select(
        F.regexp_extract("key", "^vehicle:(.*):state$", 1).alias("vehicle_id"),
        F.nullif("driver_id", F.lit("")).alias("driver_id"),
        *[value.alias(name) for name, value in number.items()],
        F.nullif("event_time", F.lit("")).alias("event_time"),
    )


def fleet_speed(state: DataFrame) -> DataFrame:
    """Tracked vehicles and their mean current speed, 0 when none is known."""
    return state.agg(
        F.count("*").alias("vehicles_tracked"),
        F.coalesce(F.avg("speed_kmh"), F.lit(0.0)).alias("avg_speed_kmh"),
    )
