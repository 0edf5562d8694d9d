"""Monitoring gauges as rows ``(metric, label, value)``.

Every event type is scanned once, for its counts, its anomalies and its quality checks together. A
label without data keeps its sentinel: 0 events, age -1, 0 anomalies, 0 drivers, score 0.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.plans.quality import SUITES, Check, unexpected
from convoy.plans.state import fleet_speed
from convoy.schemas import ANOMALY_TYPES, DRIVER_STATUSES


def _gauge(metric: str, label: str | Column | None, value: Column) -> Column:
    label = label if isinstance(label, Column) else F.lit(label).cast("string")
    return F.struct(
        F.lit(metric).alias("metric"), label.alias("label"), value.cast("double").alias("value")
    )


def _rows(totals: DataFrame, *gauges: Column) -> DataFrame:
    return totals.select(F.inline(F.array(*gauges)))


def _type_totals(
    event_type: str, rows: DataFrame, as_of: Column, checks: list[Check]
) -> DataFrame:
    """One row: the lake gauges of an event type as an array, its checks and those passed."""
    anomalies = ANOMALY_TYPES if "anomaly_types" in rows.columns else []
    totals = rows.agg(
        F.count("*").alias("n"),
        F.max(F.col("event_time").cast("timestamp")).alias("newest"),
        *[F.count_if(F.array_contains("anomaly_types", a)).alias(a) for a in anomalies],
        *[unexpected(rows, check).alias(f"check{i}") for i, check in enumerate(checks)],
    )
    age = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros("newest")) / 1_000_000
    gauges = [
        _gauge("delivery_lake_events_total", event_type, F.col("n")),
        _gauge("delivery_lake_last_event_age_seconds", event_type, F.coalesce(age, F.lit(-1.0))),
        *[_gauge("delivery_lake_anomalies_total", a, F.col(a)) for a in anomalies],
    ]
    passed = [F.coalesce(F.col(f"check{i}") == 0, F.lit(False)) for i in range(len(checks))]
    return totals.select(
        F.lit(event_type).alias("event_type"),
        F.array(*gauges).alias("gauges"),
        F.when(F.col("n") > 0, len(checks)).otherwise(0).alias("n_checks"),
        F.when(F.col("n") > 0, sum((p.cast("int") for p in passed), F.lit(0)))
        .otherwise(0)
        .alias("n_passed"),
    )


def lake_gauges(event_type: str, rows: DataFrame, as_of: Column) -> DataFrame:
    """Events, age of the newest one and, for positions, anomalies by type."""
    return _type_totals(event_type, rows, as_of, []).select(F.inline("gauges"))


def lake_and_quality_gauges(lake: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Lake gauges and quality scores of all event types."""
    types = reduce(
        DataFrame.unionByName,
        [_type_totals(t, rows, as_of, SUITES[t]) for t, rows in lake.items()],
    )

    def score(passed: Column, checks: Column) -> Column:
        return F.when(checks > 0, F.lit(100.0) * passed / checks).otherwise(0.0)

    by_type = _gauge(
        "delivery_data_quality_score_by_type", F.col("event_type"), score(F.col("n_passed"), F.col("n_checks"))
    )
    # One row per event type, four at most, come together here.
    totals = types.agg(
        F.flatten(F.collect_list(F.array_append("gauges", by_type))).alias("gauges"),
        F.sum("n_checks").alias("n_checks"),
        F.sum("n_passed").alias("n_passed"),
    )
    overall = [
        _gauge("delivery_data_quality_score", None, F.round(score(F.col("n_passed"), F.col("n_checks")), 1)),
        _gauge("delivery_data_quality_expectations_total", None, F.col("n_checks")),
        _gauge("delivery_data_quality_expectations_passed", None, F.col("n_passed")),
    ]
    return totals.select(F.inline(F.concat("gauges", F.array(*overall))))


def driver_gauges(driver_events: DataFrame) -> DataFrame:
    """Drivers by latest status; events without a time and unlisted statuses are left out."""
    latest = (
        driver_events.filter("driver_id is not null and event_time is not null")
        .groupBy("driver_id")
        .agg(F.max(F.struct("event_time", "status")).alias("latest"))
    )
    totals = latest.agg(
        *[F.count_if(F.col("latest.status") == s).alias(s) for s in DRIVER_STATUSES]
    )
    return _rows(totals, *[_gauge("delivery_drivers_by_status", s, F.col(s)) for s in DRIVER_STATUSES])


def state_gauges(state: DataFrame) -> DataFrame:
    return _rows(
        fleet_speed(state),
        _gauge("delivery_vehicles_tracked", None, F.col("vehicles_tracked")),
        _gauge("delivery_vehicles_avg_speed_kmh", None, F.col("avg_speed_kmh")),
    )


def fleet_metrics(lake: dict[str, DataFrame], state: DataFrame, as_of: Column) -> DataFrame:
    """All gauges."""
    return (
        lake_and_quality_gauges(lake, as_of)
        .unionByName(driver_gauges(lake["driver"]))
        .unionByName(state_gauges(state))
    )
