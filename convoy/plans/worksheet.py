"""Exploration and audit queries over the RAW tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def raw_counts(raw: dict[str, DataFrame]) -> DataFrame:
    """Rows per RAW table."""
    counts = [
        rows.agg(F.count("*").alias("n_rows")).select(
            F.lit(name.upper()).alias("event_type"), "n_rows"
        )
        for name, rows in raw.items()
    ]
    return reduce(DataFrame.unionByName, counts).orderBy("event_type")


def gps_events_per_day(raw_gps: DataFrame, days: int = 7) -> DataFrame:
    """The newest days; rows without a time count as a day of their own and sort first."""
    return (
        raw_gps.groupBy(F.to_date("event_time").alias("event_date"))
        .agg(F.count("*").alias("n_events"))
        .orderBy(F.col("event_date").desc_nulls_first())
        .limit(days)
    )


def delivery_status_histogram(raw_delivery: DataFrame) -> DataFrame:
    return (
        raw_delivery.groupBy("status")
        .agg(F.count("*").alias("n"))
        .orderBy(F.col("n").desc(), "status")
    )


def driver_status_counts(raw_driver: DataFrame) -> DataFrame:
    """Drivers per latest status; an event without a time counts as the latest."""
    latest = F.max(F.struct(F.col("event_time").isNull().alias("untimed"), "event_time", "status"))
    return (
        raw_driver.groupBy("driver_id")
        .agg(latest.alias("latest"))
        .groupBy(F.col("latest.status").alias("status"))
        .agg(F.count("*").alias("n_drivers"))
        .orderBy(F.col("n_drivers").desc(), "status")
    )


def rows_loaded_per_day(raw_gps: DataFrame) -> DataFrame:
    return (
        raw_gps.groupBy(F.to_date("load_timestamp").alias("load_date"))
        .agg(F.count("*").alias("n_rows_loaded"))
        .orderBy(F.col("load_date").desc_nulls_first())
    )
