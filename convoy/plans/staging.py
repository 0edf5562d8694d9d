"""Staging tables: typed, filtered, one row per business key.

The filters sit below the grouping, where Catalyst pushes them into the Parquet scan.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions import in_service_area
from convoy.operators import latest_by
from convoy.schemas import DRIVER_STATUSES, STAGED_DELIVERY_STATUSES


def _clean_status() -> Column:
    return F.lower(F.trim("status")).alias("status")


def stg_gps_events(raw_gps: DataFrame) -> DataFrame:
    positions = raw_gps.filter(
        F.col("vehicle_id").isNotNull()
        & F.col("event_time").isNotNull()
        & (F.col("speed_kmh") >= 0)
        & in_service_area(F.col("lat"), F.col("lon"))
    ).select(
        "vehicle_id",
        "driver_id",
        F.col("lat").cast("double").alias("latitude"),
        F.col("lon").cast("double").alias("longitude"),
        F.col("speed_kmh").cast("double").alias("speed_kmh"),
        "event_time",
        "load_timestamp",
    )
    return latest_by(positions, ["vehicle_id", "event_time"], ["load_timestamp"])


def stg_delivery_events(raw_delivery: DataFrame) -> DataFrame:
    # The status is tested as loaded: a value that needs trimming is not accepted.
    steps = raw_delivery.filter(
        F.col("package_id").isNotNull()
        & F.col("order_id").isNotNull()
        & F.col("event_time").isNotNull()
        & F.col("status").isin(STAGED_DELIVERY_STATUSES)
    ).select(
        "package_id",
        "order_id",
        "vehicle_id",
        "driver_id",
        _clean_status(),
        "event_time",
        "load_timestamp",
    )
    return latest_by(steps, ["package_id", "event_time"], ["load_timestamp"])


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    orders = raw_orders.filter(
        F.col("order_id").isNotNull()
        & F.col("package_id").isNotNull()
        & F.col("event_time").isNotNull()
    ).select("order_id", "package_id", _clean_status(), "event_time", "load_timestamp")
    return latest_by(orders, ["order_id"], ["load_timestamp", "event_time"])


def stg_driver_events(raw_driver: DataFrame) -> DataFrame:
    changes = raw_driver.filter(
        F.col("driver_id").isNotNull()
        & F.col("event_time").isNotNull()
        & F.col("status").isin(DRIVER_STATUSES)
    ).select("driver_id", "vehicle_id", _clean_status(), "event_time", "load_timestamp")
    return latest_by(changes, ["driver_id", "event_time"], ["load_timestamp"])


STAGING = {
    "stg_gps_events": (stg_gps_events, "gps_events"),
    "stg_delivery_events": (stg_delivery_events, "delivery_events"),
    "stg_orders": (stg_orders, "orders"),
    "stg_driver_events": (stg_driver_events, "driver_events"),
}


def staging_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The four staging tables from the four RAW tables."""
    return {name: build(raw[source]) for name, (build, source) in STAGING.items()}
