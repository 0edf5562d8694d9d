"""Data-quality suites and table tests.

A whole suite is one aggregate over one scan of its table, however many checks it has.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.schemas import (
    DELIVERY_STATUSES,
    DRIVER_STATUSES,
    EVENT_TYPES,
    FINAL_STATUSES,
    LAT_MAX,
    LAT_MIN,
    LON_MAX,
    LON_MIN,
    ORDER_STATUSES,
    STAGED_DELIVERY_STATUSES,
)


@dataclass(frozen=True)
class Check:
    """One rule about one column. Range and set rules let nulls pass; bounds are inclusive."""

    kind: str
    column: str
    low: float | None = None
    high: float | None = None
    values: tuple[str, ...] = ()

    def broken(self) -> Column:
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "in_set":
            return ~value.isin(*self.values)
        bounds = []
        if self.low is not None:
            bounds.append(value < self.low)
        if self.high is not None:
            bounds.append(value > self.high)
        return reduce(lambda a, b: a | b, bounds)


def not_null(*columns: str) -> list[Check]:
    return [Check("not_null", c) for c in columns]


def between(column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check("between", column, low=low, high=high)


def in_set(column: str, values: list[str]) -> Check:
    return Check("in_set", column, values=tuple(values))


SUITES = {
    "gps": [
        *not_null("vehicle_id", "driver_id"),
        between("lat", LAT_MIN, LAT_MAX),
        between("lon", LON_MIN, LON_MAX),
        between("speed_kmh", low=0.0),
    ],
    "delivery": [
        *not_null("package_id", "order_id", "vehicle_id"),
        in_set("status", DELIVERY_STATUSES),
    ],
    "order": [*not_null("order_id", "package_id"), in_set("status", ORDER_STATUSES)],
    "driver": [*not_null("driver_id", "vehicle_id"), in_set("status", DRIVER_STATUSES)],
}


def unexpected(table: DataFrame, check: Check) -> Column:
    """Aggregate: rows that break the check; null when the table lacks the column."""
    if check.column not in table.columns:
        return F.lit(None).cast("bigint")
    return F.count_if(check.broken())


def run_checks(table: DataFrame, checks: list[Check]) -> DataFrame:
    """``(expectation, column, n_rows, n_unexpected)`` per check, in one pass over the table.

    A check on a column the table lacks has a null count.
    """
    totals = table.agg(
        F.count("*").alias("n_rows"),
        *[unexpected(table, check).alias(f"check{i}") for i, check in enumerate(checks)],
    )
    rows = [
        F.struct(
            F.lit(check.kind).alias("expectation"),
            F.lit(check.column).alias("column"),
            "n_rows",
            F.col(f"check{i}").alias("n_unexpected"),
        )
        for i, check in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*rows)))


def validate(table: DataFrame, event_type: str) -> DataFrame:
    """Results of the suite of one event type; no rows in, no results out."""
    return (
        run_checks(table, SUITES[event_type])
        .filter("n_rows > 0")
        .select(
            F.lit(event_type).alias("event_type"),
            "expectation",
            "column",
            F.coalesce(F.col("n_unexpected") == 0, F.lit(False)).alias("success"),
            "n_unexpected",
            "n_rows",
        )
    )


def quality_results(lake: dict[str, DataFrame]) -> DataFrame:
    """All suites over the event types at hand."""
    return reduce(
        DataFrame.unionByName, [validate(rows, event_type) for event_type, rows in lake.items()]
    )


def quality_score(results: DataFrame) -> DataFrame:
    """Checks, successes and score per event type and, as scope ``all``, in total.

    A type without data scores 0, and so does an empty lake.
    """
    passed = F.count_if("success")
    scopes = [F.lit(t) for t in EVENT_TYPES]
    by_type = [
        F.struct(
            scope.alias("scope"),
            F.count_if(F.col("event_type") == scope).alias("n_expectations"),
            F.count_if((F.col("event_type") == scope) & F.col("success")).alias("n_success"),
        )
        for scope in scopes
    ]
    total = F.struct(
        F.lit("all").alias("scope"),
        F.count("*").alias("n_expectations"),
        passed.alias("n_success"),
    )
    score = F.lit(100.0) * F.col("n_success") / F.col("n_expectations")
    return (
        results.agg(F.array(*by_type, total).alias("scores"))
        .select(F.inline("scores"))
        .withColumn(
            "quality_score",
            F.when(F.col("n_expectations") == 0, 0.0)
            .when(F.col("scope") == "all", F.round(score, 1))
            .otherwise(score),
        )
        .withColumn(
            "all_passed",
            (F.col("n_expectations") > 0) & (F.col("n_success") == F.col("n_expectations")),
        )
    )


def quality_report(results: DataFrame) -> tuple[str, bool]:
    """Readable report of the 15 or fewer results, and whether everything passed."""
    lines = []
    for r in results.orderBy("event_type", "column", "expectation").collect():
        mark = "ok  " if r["success"] else "FAIL"
        lines.append(f"{mark} {r['event_type']:9} {r['expectation']:9} [{r['column']}] {r['n_rows']} rows")
    total = quality_score(results).filter("scope = 'all'").first()
    lines.append(
        f"score {total['quality_score']}% ({total['n_success']}/{total['n_expectations']} checks)"
    )
    return "\n".join(lines), total["all_passed"]


# --- table tests -------------------------------------------------------------


@dataclass(frozen=True)
class TableTests:
    checks: list[Check]
    unique: tuple[str, ...] = ()


SOURCE_TESTS = {
    "gps_events": TableTests(not_null("vehicle_id", "driver_id", "event_time")),
    "delivery_events": TableTests(not_null("package_id", "order_id", "event_time")),
    "orders": TableTests(not_null("order_id", "package_id", "event_time")),
    "driver_events": TableTests(not_null("driver_id", "event_time")),
}

STAGING_TESTS = {
    "stg_gps_events": TableTests(not_null("vehicle_id", "driver_id", "event_time")),
    "stg_delivery_events": TableTests(
        [
            *not_null("package_id", "order_id", "status", "event_time"),
            in_set("status", STAGED_DELIVERY_STATUSES),
        ]
    ),
    "stg_orders": TableTests(not_null("order_id", "package_id", "event_time"), ("order_id",)),
    "stg_driver_events": TableTests(
        [*not_null("driver_id", "status", "event_time"), in_set("status", DRIVER_STATUSES)]
    ),
}

MART_TESTS = {
    "dim_drivers": TableTests(
        [*not_null("driver_id", "current_status"), in_set("current_status", DRIVER_STATUSES)],
        ("driver_id",),
    ),
    "dim_vehicles": TableTests(not_null("vehicle_id"), ("vehicle_id",)),
    "dim_date": TableTests(not_null("date_day"), ("date_day",)),
    "fct_deliveries": TableTests(
        [*not_null("package_id", "final_status"), in_set("final_status", FINAL_STATUSES)],
        ("package_id",),
    ),
    "fct_daily_activity": TableTests(not_null("activity_date"), ("activity_date",)),
}

TABLE_TESTS = {**SOURCE_TESTS, **STAGING_TESTS, **MART_TESTS}


def repeated_values(table: DataFrame, column: str) -> DataFrame:
    """Number of known values that occur more than once."""
    return (
        table.filter(F.col(column).isNotNull())
        .groupBy(column)
        .count()
        .agg(F.count_if(F.col("count") > 1).alias("n_failing"))
    )


def run_table_tests(name: str, table: DataFrame) -> DataFrame:
    """``(table_name, test, column, n_failing, success)`` for every test of one table."""
    tests = TABLE_TESTS[name]
    found = [
        run_checks(table, tests.checks).select(
            F.col("expectation").alias("test"), "column", F.col("n_unexpected").alias("n_failing")
        )
    ]
    for column in tests.unique:
        found.append(
            repeated_values(table, column).select(
                F.lit("unique").alias("test"), F.lit(column).alias("column"), "n_failing"
            )
        )
    return reduce(DataFrame.unionByName, found).select(
        F.lit(name).alias("table_name"),
        "test",
        "column",
        "n_failing",
        (F.col("n_failing") == 0).alias("success"),
    )


def table_tests(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [run_table_tests(name, table) for name, table in tables.items()]
    )
