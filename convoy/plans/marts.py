"""Star schema: three dimensions, two facts.

Distinct counts are taken in two steps, first one row per (group, thing) and then a sum, so that
the wide input is shuffled at most once and is combined on the map side before that.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions import boundary_diff, percentage
from convoy.operators import asof_join
from convoy.schemas import CALENDAR_MARGIN_DAYS


def _refreshed(mart: DataFrame, as_of: Column | None) -> DataFrame:
    return mart if as_of is None else mart.withColumn("mart_refreshed_at", as_of)


def gps_day_rollup(stg_gps: DataFrame) -> DataFrame:
    """Positions per vehicle, day and driver: the one pass over positions that both
    ``gps_daily`` and ``dim_vehicles`` start from."""
    return stg_gps.groupBy(
        "vehicle_id", F.to_date("event_time").alias("activity_date"), "driver_id"
    ).agg(
        F.count("*").alias("n_points"),
        F.sum("speed_kmh").alias("sum_speed_kmh"),
        F.count("speed_kmh").alias("n_speeds"),
        F.min("speed_kmh").alias("min_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
    )


def gps_daily(day_rollup: DataFrame) -> DataFrame:
    """Fleet activity per day, from ``gps_day_rollup``."""
    return day_rollup.groupBy("activity_date").agg(
        F.count_distinct("vehicle_id").alias("n_active_vehicles"),
        F.count_distinct("driver_id").alias("n_active_drivers"),
        F.round(F.sum("sum_speed_kmh") / F.sum("n_speeds"), 2).alias("fleet_avg_speed_kmh"),
        F.sum("n_points").alias("n_gps_points"),
    )


def _package_outcomes(steps: DataFrame, *group: Column | str) -> DataFrame:
    """One row per group and package: which statuses it reached."""
    reached = {"delivered": "delivered", "failed": "failed", "picked_up": "picked_up"}
    return steps.groupBy(*group, "package_id").agg(
        *[F.max(F.when(F.col("status") == s, 1).otherwise(0)).alias(n) for n, s in reached.items()]
    )


def delivery_daily(stg_delivery: DataFrame) -> DataFrame:
    """Packages touched and brought to each outcome per day."""
    day = F.to_date("event_time").alias("activity_date")
    return (
        _package_outcomes(stg_delivery, day)
        .groupBy("activity_date")
        .agg(
            F.count("package_id").alias("n_deliveries_touched"),
            F.sum("delivered").alias("n_delivered"),
            F.sum("failed").alias("n_failed"),
            F.sum("picked_up").alias("n_picked_up"),
        )
    )


def fct_daily_activity(
    day_rollup: DataFrame, stg_delivery: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """One row per day that has positions or deliveries, newest first."""
    counts = [
        "n_active_vehicles",
        "n_active_drivers",
        "n_gps_points",
        "n_deliveries_touched",
        "n_delivered",
        "n_failed",
        "n_picked_up",
    ]
    days = gps_daily(day_rollup).join(delivery_daily(stg_delivery), "activity_date", "full")
    days = days.fillna(0, subset=counts).withColumn(
        "daily_success_rate_pct", percentage(F.col("n_delivered"), F.col("n_failed"))
    )
    return _refreshed(
        days.select(
            "activity_date",
            "n_active_vehicles",
            "n_active_drivers",
            "fleet_avg_speed_kmh",
            "n_gps_points",
            "n_deliveries_touched",
            "n_delivered",
            "n_failed",
            "n_picked_up",
            "daily_success_rate_pct",
        ),
        as_of,
    ).orderBy(F.col("activity_date").desc())


def dim_vehicles(day_rollup: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per vehicle; the overall speed is the plain mean of its daily means."""
    days = (
        day_rollup.filter("n_speeds > 0")
        .groupBy("vehicle_id", "activity_date")
        .agg(
            F.sum("n_speeds").alias("n_gps_points"),
            (F.sum("sum_speed_kmh") / F.sum("n_speeds")).alias("avg_speed_kmh"),
            F.max("max_speed_kmh").alias("max_speed_kmh"),
            F.count("driver_id").alias("n_distinct_drivers"),
        )
    )
    return _refreshed(
        days.groupBy("vehicle_id").agg(
            F.count("activity_date").alias("n_active_days"),
            F.min("activity_date").alias("first_active_date"),
            F.max("activity_date").alias("last_active_date"),
            F.sum("n_gps_points").alias("total_gps_points"),
            F.round(F.avg("avg_speed_kmh"), 2).alias("avg_speed_kmh_overall"),
            F.max("max_speed_kmh").alias("max_speed_ever_kmh"),
            F.max("n_distinct_drivers").alias("max_drivers_per_day"),
        ),
        as_of,
    )


def driver_activity(stg_driver: DataFrame) -> DataFrame:
    """Latest status and activity span per driver, in a single grouping."""
    latest = F.max(F.struct("event_time", "vehicle_id", "status"))
    return (
        stg_driver.groupBy("driver_id")
        .agg(
            latest.alias("latest"),
            F.min("event_time").alias("first_seen_at"),
            F.max("event_time").alias("last_seen_at"),
            F.count("*").alias("total_status_changes"),
        )
        .select(
            "driver_id",
            F.col("latest.vehicle_id").alias("current_vehicle_id"),
            F.col("latest.status").alias("current_status"),
            F.col("latest.event_time").alias("last_status_change"),
            "first_seen_at",
            "last_seen_at",
            boundary_diff("HOUR", F.col("first_seen_at"), F.col("last_seen_at")).alias(
                "active_hours"
            ),
            "total_status_changes",
        )
    )


def delivery_counts(steps: DataFrame) -> DataFrame:
    """Packages delivered and failed per known driver."""
    return (
        _package_outcomes(steps.filter("driver_id is not null"), "driver_id")
        .groupBy("driver_id")
        .agg(
            F.sum("delivered").alias("n_deliveries_completed"),
            F.sum("failed").alias("n_deliveries_failed"),
        )
    )


def dim_drivers(
    stg_driver: DataFrame, steps: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """One row per driver. ``steps`` are delivery events that carry a ``driver_id``:
    ``stg_delivery_events`` as loaded, or ``deliveries_with_driver`` to credit the driver found
    by the as-of join (events carry none on the wire)."""
    counted = ["n_deliveries_completed", "n_deliveries_failed"]
    drivers = (
        driver_activity(stg_driver)
        .join(delivery_counts(steps), "driver_id", "left")
        .fillna(0, subset=counted)
        .withColumn("success_rate_pct", percentage(*[F.col(c) for c in counted]))
    )
    return _refreshed(drivers, as_of)


def driver_history(stg_driver: DataFrame) -> DataFrame:
    """Who took which vehicle when."""
    return stg_driver.filter("vehicle_id is not null and driver_id is not null").select(
        "vehicle_id", "driver_id", F.col("event_time").alias("driver_assigned_at")
    )


def deliveries_with_driver(stg_delivery: DataFrame, stg_driver: DataFrame) -> DataFrame:
    """Delivery events with the driver at the wheel of the vehicle at that moment, if any."""
    return asof_join(
        stg_delivery.select("package_id", "order_id", "vehicle_id", "status", "event_time"),
        driver_history(stg_driver),
        key="vehicle_id",
        left_time="event_time",
        right_time="driver_assigned_at",
        values=["driver_id"],
    )


def delivery_pivot(steps: DataFrame) -> DataFrame:
    """One row per package with the (last) time of every status."""
    at = {
        "picked_up_at": "picked_up",
        "in_transit_at": "in_transit",
        "delivered_at": "delivered",
        "failed_at": "failed",
    }
    return steps.groupBy("package_id").agg(
        F.max("order_id").alias("order_id"),
        F.max("vehicle_id").alias("vehicle_id"),
        F.max("driver_id").alias("driver_id"),
        *[F.max(F.when(F.col("status") == s, F.col("event_time"))).alias(n) for n, s in at.items()],
    )


def fct_deliveries(
    stg_delivery: DataFrame,
    stg_orders: DataFrame,
    stg_driver: DataFrame,
    as_of: Column | None = None,
) -> DataFrame:
    """One row per package: times of every step, final status, durations in minutes."""
    ordered = stg_orders.select("order_id", F.col("event_time").alias("order_created_at"))
    packages = delivery_pivot(deliveries_with_driver(stg_delivery, stg_driver)).join(
        ordered, "order_id", "left"
    )
    created, picked, delivered = (
        F.col("order_created_at"),
        F.col("picked_up_at"),
        F.col("delivered_at"),
    )
    final_status = (
        F.when(F.col("delivered_at").isNotNull(), "delivered")
        .when(F.col("failed_at").isNotNull(), "failed")
        .when(F.col("in_transit_at").isNotNull(), "in_transit")
        .when(F.col("picked_up_at").isNotNull(), "picked_up")
        .otherwise("pending")
    )
    return _refreshed(
        packages.select(
            "package_id",
            "order_id",
            "vehicle_id",
            "driver_id",
            "order_created_at",
            "picked_up_at",
            "in_transit_at",
            "delivered_at",
            "failed_at",
            final_status.alias("final_status"),
            boundary_diff("MINUTE", created, picked).alias("minutes_order_to_pickup"),
            boundary_diff("MINUTE", picked, delivered).alias("minutes_pickup_to_delivery"),
            boundary_diff("MINUTE", created, delivered).alias("minutes_order_to_delivery"),
            F.col("delivered_at").isNotNull().alias("is_delivered"),
            F.col("failed_at").isNotNull().alias("is_failed"),
        ),
        as_of,
    )


def date_spine(daily_activity: DataFrame) -> DataFrame:
    """One row per day from 30 days before the first active day to 30 after the last."""
    start = F.date_add(F.min("activity_date"), -CALENDAR_MARGIN_DAYS)
    end = F.date_add(F.max("activity_date"), CALENDAR_MARGIN_DAYS)
    return (
        daily_activity.agg(start.alias("start_date"), end.alias("end_date"))
        .filter("start_date is not null")
        .select(F.explode(F.sequence("start_date", "end_date")).alias("date_day"))
    )


def dim_date(
    daily_activity: DataFrame, today: Column | None = None, as_of: Column | None = None
) -> DataFrame:
    """Calendar; ``today`` adds ``days_from_today``."""
    day = F.col("date_day")
    weekend = F.dayofweek(day).isin(1, 7)
    columns = [
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.dayofweek(day) - 1).alias("day_of_week_num"),
        F.dayname(day).alias("day_of_week_name"),
        F.monthname(day).alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        weekend.alias("is_weekend"),
        (~weekend).alias("is_business_day"),
        F.trunc(day, "MM").alias("month_start"),
        F.last_day(day).alias("month_end"),
        F.trunc(day, "QUARTER").alias("quarter_start"),
        F.trunc(day, "YEAR").alias("year_start"),
    ]
    if today is not None:
        columns.insert(11, F.datediff(day, today).alias("days_from_today"))
    return _refreshed(date_spine(daily_activity).select(*columns), as_of).orderBy("date_day")


def kpi_cards(
    deliveries: DataFrame, vehicles: DataFrame, drivers: DataFrame, daily_activity: DataFrame
) -> DataFrame:
    """Headline numbers of the dashboard, one row."""
    delivered = F.sum(F.col("is_delivered").cast("int"))
    failed = F.sum(F.col("is_failed").cast("int"))
    return (
        deliveries.agg(
            F.count("*").alias("total_deliveries"),
            percentage(delivered, failed).alias("success_rate_pct"),
        )
        .crossJoin(vehicles.agg(F.count("*").alias("active_vehicles")))
        .crossJoin(drivers.agg(F.count("*").alias("active_drivers")))
        .crossJoin(daily_activity.agg(F.count("*").alias("activity_days")))
    )
