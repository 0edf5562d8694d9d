"""Movement metrics and anomaly flags of vehicle positions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.functions import haversine_km, whole_seconds
from convoy.operators import with_previous
from convoy.schemas import (
    IMMOBILE_BELOW_KMH,
    MAX_SPEED_GAP_KMH,
    MAX_SPEED_KMH,
    MAX_STEP_KM,
)

POSITION = ["lat", "lon", "event_time"]


def with_previous_position(positions: DataFrame, distinct: bool = False) -> DataFrame:
    """``prev_lat``, ``prev_lon``, ``prev_event_time`` of the same vehicle.

    Positions without a time have no predecessor and are none: where they belong is unknown, and a stream
    could not know those still to come. Equal times are told apart by the other columns, the
    time of arrival first. ``distinct``: no two rows are identical.
    """
    order = ["event_time"]
    if "kafka_timestamp" in positions.columns:
        order.append("kafka_timestamp")
    order += [c for c in positions.columns if c not in order and c != "vehicle_id"]
    cuts = [F.date_trunc("HOUR", "event_time"), F.date_trunc("MINUTE", "event_time")]
    # positions without a time go through the same plan, spread evenly, so that nothing is parsed twice
    timed = F.col("event_time").isNotNull()
    spread = F.when(timed, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*positions.columns), F.lit(1024)))
    keys = ["vehicle_id", "_spread"]
    found = with_previous(positions.withColumn("_spread", spread), keys, order, POSITION, cuts, distinct)
    return found.withColumns({f"prev_{c}": F.when(timed, F.col(f"prev_{c}")) for c in POSITION}).drop("_spread")


def with_movement(positions: DataFrame) -> DataFrame:
    """Distance, elapsed whole seconds, speed and standstill, from the ``prev_`` columns."""
    return (
        positions.withColumns(
            {
                "distance_km": haversine_km(
                    F.col("prev_lat"), F.col("prev_lon"), F.col("lat"), F.col("lon")
                ),
                "elapsed_seconds": whole_seconds(F.col("event_time"))
                - whole_seconds(F.col("prev_event_time")),
            }
        )
        .withColumn(
            "computed_speed_kmh",
            F.when(
                F.col("elapsed_seconds") > 0,
                F.col("distance_km") / F.col("elapsed_seconds") * 3600.0,
            ),
        )
        .withColumn("is_immobile", F.col("computed_speed_kmh") < IMMOBILE_BELOW_KMH)
    )


def add_movement_metrics(positions: DataFrame, distinct: bool = False) -> DataFrame:
    return with_movement(with_previous_position(positions, distinct))


def add_anomaly_flags(positions: DataFrame) -> DataFrame:
    """``anomaly_types`` in fixed order, empty when nothing is wrong, and ``is_anomaly``."""
    computed = F.col("computed_speed_kmh")
    rules = {
        "SPEED_TOO_HIGH": computed > MAX_SPEED_KMH,
        "SPEED_MISMATCH": F.abs(computed - F.col("speed_kmh")) > MAX_SPEED_GAP_KMH,
        "IMMOBILE": F.col("is_immobile"),
        "GPS_JUMP": F.col("distance_km") > MAX_STEP_KM,
    }
    found = [F.when(rule, F.lit(name)) for name, rule in rules.items()]
    return positions.withColumn("anomaly_types", F.array_compact(F.array(*found))).withColumn(
        "is_anomaly", F.size("anomaly_types") > 0
    )


def enrich_gps(positions: DataFrame, distinct: bool = False) -> DataFrame:
    return add_anomaly_flags(add_movement_metrics(positions, distinct))
