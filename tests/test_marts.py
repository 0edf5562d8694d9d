from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from convoy.functions import boundary_diff, percentage
from convoy.plans import marts, staging, worksheet

GPS = (
    "vehicle_id string, driver_id string, lat double, lon double, speed_kmh double, "
    "event_time timestamp, load_timestamp timestamp"
)
DELIVERY = (
    "package_id string, order_id string, vehicle_id string, driver_id string, status string, "
    "event_time timestamp, load_timestamp timestamp"
)
ORDERS = "order_id string, package_id string, status string, event_time timestamp, load_timestamp timestamp"
DRIVER = "driver_id string, vehicle_id string, status string, event_time timestamp, load_timestamp timestamp"
LOADED = "2026-01-05 00:00:00"


@pytest.fixture
def gps(frame):
    def rows(*points):
        return staging.stg_gps_events(
            frame(GPS, *[(v, d, 45.5, -73.6, speed, t, LOADED) for v, d, speed, t in points])
        )

    return rows


@pytest.fixture
def delivery(frame):
    def rows(*steps):
        return staging.stg_delivery_events(
            frame(DELIVERY, *[(p, o, v, None, s, t, LOADED) for p, o, v, s, t in steps])
        )

    return rows


@pytest.fixture
def drivers(frame):
    def rows(*changes):
        return staging.stg_driver_events(frame(DRIVER, *[(*c, LOADED) for c in changes]))

    return rows


@pytest.fixture
def orders(frame):
    def rows(*created):
        return staging.stg_orders(frame(ORDERS, *[(o, p, "created", t, LOADED) for o, p, t in created]))

    return rows


# --- staging -----------------------------------------------------------------


def test_stg_gps_filters_and_renames(frame):
    t = "2026-01-01 10:00:00"
    raw = frame(
        GPS,
        ("edge", "d", 45.0, -74.5, 0.0, t, t),
        ("far", "d", 48.9, 2.35, 1.0, t, t),
        ("nolat", "d", None, -73.6, 1.0, t, t),
        ("nospeed", "d", 45.5, -73.6, None, t, t),
        ("back", "d", 45.5, -73.6, -0.1, t, t),
        (None, "d", 45.5, -73.6, 1.0, t, t),
        ("notime", "d", 45.5, -73.6, 1.0, None, t),
    )
    staged = staging.stg_gps_events(raw)
    assert [r.vehicle_id for r in staged.collect()] == ["edge"]
    assert staged.columns[2:4] == ["latitude", "longitude"]


def test_stg_gps_keeps_the_newest_load(frame):
    t = "2026-01-01 10:00:00"
    raw = frame(
        GPS,
        ("v", "d", 45.5, -73.6, 1.0, t, "2026-01-01 11:00:00"),
        ("v", "d", 45.5, -73.6, 2.0, t, "2026-01-01 12:00:00"),
        ("v", "d", 45.5, -73.6, 3.0, "2026-01-01 10:00:01", "2026-01-01 11:00:00"),
    )
    assert sorted(r.speed_kmh for r in staging.stg_gps_events(raw).collect()) == [2.0, 3.0]


def test_statuses_are_tested_as_loaded(frame):
    t = "2026-01-01 10:00:00"
    raw = frame(
        DELIVERY,
        ("p1", "o", "v", None, "delivered", t, t),
        ("p2", "o", "v", None, "created", t, t),
        ("p3", "o", "v", None, " Delivered ", t, t),
        ("p4", None, "v", None, "failed", t, t),
    )
    assert [r.package_id for r in staging.stg_delivery_events(raw).collect()] == ["p1"]
    changes = frame(DRIVER, ("d1", None, "online", t, t), ("d2", "v", " Online ", t, t))
    assert [r.driver_id for r in staging.stg_driver_events(changes).collect()] == ["d1"]


def test_stg_orders_one_row_per_order(frame):
    raw = frame(
        ORDERS,
        ("o", "p", "created", "2026-01-01 10:00:00", "2026-01-01 11:00:00"),
        ("o", "p", " Created ", "2026-01-01 10:01:00", "2026-01-01 11:00:00"),
        ("o", "p", "created", "2026-01-01 10:09:00", "2026-01-01 10:30:00"),
    )
    row = staging.stg_orders(raw).first()
    assert (row.status, row.event_time.minute) == ("created", 1)


# --- facts -------------------------------------------------------------------


def test_delivery_gets_the_driver_at_the_wheel(delivery, drivers):
    steps = delivery(
        ("p1", "o1", "v1", "picked_up", "2026-01-01 09:59:59"),
        ("p1", "o1", "v1", "in_transit", "2026-01-01 10:00:00"),
        ("p1", "o1", "v1", "delivered", "2026-01-03 12:00:00"),
        ("p2", "o2", "v9", "picked_up", "2026-01-03 12:00:00"),
    )
    history = drivers(
        ("d1", "v1", "online", "2026-01-01 10:00:00"),
        ("d2", "v1", "online", "2026-01-02 10:00:00"),
        ("d3", "v1", "online", "2026-01-04 10:00:00"),
        ("d0", None, "online", "2026-01-03 10:00:00"),
    )
    found = marts.deliveries_with_driver(steps, history).orderBy("event_time", "package_id").collect()
    assert [r.driver_id for r in found] == [None, "d1", "d2", None]


def test_greatest_driver_wins_a_tie(delivery, drivers):
    steps = delivery(("p", "o", "v", "picked_up", "2026-01-01 10:00:00"))
    history = drivers(
        ("d1", "v", "online", "2026-01-01 10:00:00"), ("d2", "v", "online", "2026-01-01 10:00:00")
    )
    assert marts.deliveries_with_driver(steps, history).first().driver_id == "d2"


def test_fct_deliveries(delivery, orders, drivers):
    steps = delivery(
        ("done", "o1", "v", "picked_up", "2026-01-01 10:00:59"),
        ("done", "o1", "v", "in_transit", "2026-01-01 10:10:00"),
        ("done", "o1", "v", "delivered", "2026-01-01 10:31:01"),
        ("done", "o1", "v", "failed", "2026-01-01 10:20:00"),
        ("lost", "o2", "v", "failed", "2026-01-01 10:00:00"),
        ("going", "o3", "v", "in_transit", "2026-01-01 10:00:00"),
        ("taken", "o4", "v", "picked_up", "2026-01-01 10:00:00"),
    )
    fact = marts.fct_deliveries(
        steps, orders(("o1", "done", "2026-01-01 09:59:59")), drivers(("d", "v", "online", "2026-01-01 00:00:00"))
    )
    rows = {r.package_id: r for r in fact.collect()}
    assert {p: r.final_status for p, r in rows.items()} == {
        "done": "delivered",
        "lost": "failed",
        "going": "in_transit",
        "taken": "picked_up",
    }
    done = rows["done"]
    assert done.minutes_order_to_pickup == 1  # 09:59:59 to 10:00:59 crosses one minute mark
    assert done.minutes_pickup_to_delivery == 31
    assert done.minutes_order_to_delivery == 32
    assert done.is_delivered and done.is_failed and done.driver_id == "d"
    assert rows["lost"].order_created_at is None and rows["lost"].minutes_order_to_pickup is None


def test_pending_is_the_status_of_a_package_without_steps(frame):
    steps = frame(
        "package_id string, order_id string, vehicle_id string, driver_id string, status string, event_time timestamp",
        ("p", "o", "v", None, "created", "2026-01-01 10:00:00"),
    )
    row = marts.delivery_pivot(steps).first()
    assert row.picked_up_at is None and row.delivered_at is None


def test_fct_daily_activity_joins_both_sides(gps, delivery):
    rollup = marts.gps_day_rollup(
        gps(
            ("v1", "d1", 10.0, "2026-01-01 10:00:00"),
            ("v1", "d2", 20.0, "2026-01-01 11:00:00"),
            ("v2", "d1", 25.0, "2026-01-01 12:00:00"),
            ("v1", "d1", 5.0, "2026-01-02 00:00:00"),
        )
    )
    steps = delivery(
        ("p1", "o", "v", "picked_up", "2026-01-01 10:00:00"),
        ("p1", "o", "v", "delivered", "2026-01-01 11:00:00"),
        ("p2", "o", "v", "delivered", "2026-01-01 11:00:00"),
        ("p3", "o", "v", "failed", "2026-01-01 12:00:00"),
        ("p1", "o", "v", "delivered", "2026-01-03 11:00:00"),
    )
    rows = marts.fct_daily_activity(rollup, steps).collect()
    assert [str(r.activity_date) for r in rows] == ["2026-01-03", "2026-01-02", "2026-01-01"]
    third, second, first = rows
    assert tuple(first)[1:] == (2, 2, 18.33, 3, 3, 2, 1, 1, 66.67)
    assert tuple(second)[1:] == (1, 1, 5.0, 1, 0, 0, 0, 0, None)
    assert tuple(third)[1:] == (0, 0, None, 0, 1, 1, 0, 0, 100.0)


def test_dim_vehicles_averages_daily_averages(gps):
    rollup = marts.gps_day_rollup(
        gps(
            ("v", "d1", 10.0, "2026-01-01 10:00:00"),
            ("v", "d2", 20.0, "2026-01-01 11:00:00"),
            ("v", "d1", 30.0, "2026-01-01 12:00:00"),
            ("v", "d1", 50.0, "2026-01-03 12:00:00"),
        )
    )
    row = marts.dim_vehicles(rollup).first()
    assert tuple(row) == ("v", 2, date(2026, 1, 1), date(2026, 1, 3), 4, 35.0, 50.0, 2)


def test_dim_drivers(delivery, drivers):
    changes = drivers(
        ("d1", "v1", "online", "2026-01-01 10:59:00"),
        ("d1", "v2", "on_break", "2026-01-01 12:01:00"),
        ("d2", "v3", "offline", "2026-01-01 08:00:00"),
    )
    steps = delivery(
        ("p1", "o", "v1", "delivered", "2026-01-01 11:00:00"),
        ("p2", "o", "v1", "failed", "2026-01-01 11:30:00"),
        ("p3", "o", "v1", "delivered", "2026-01-01 11:45:00"),
    )
    rows = {r.driver_id: r for r in marts.dim_drivers(changes, steps).collect()}
    d1 = rows["d1"]
    assert (d1.current_vehicle_id, d1.current_status, d1.total_status_changes) == ("v2", "on_break", 2)
    assert d1.active_hours == 2  # 10:59 to 12:01 crosses two hour marks
    assert (d1.n_deliveries_completed, d1.success_rate_pct) == (0, None)  # events carry no driver
    resolved = marts.dim_drivers(changes, marts.deliveries_with_driver(steps, changes))
    found = {r.driver_id: (r.n_deliveries_completed, r.n_deliveries_failed, r.success_rate_pct) for r in resolved.collect()}
    assert found == {"d1": (2, 1, 66.67), "d2": (0, 0, None)}


# --- calendar ----------------------------------------------------------------


def test_calendar_margins_and_flags(frame):
    days = frame("activity_date string", ("2026-01-04",)).selectExpr("date(activity_date) activity_date")
    rows = marts.dim_date(days, today=F.lit("2026-01-05").cast("date")).collect()
    assert len(rows) == 61 and str(rows[0].date_day) == "2025-12-05"
    sunday = rows[30]
    assert (sunday.day_of_week_num, sunday.day_of_week_name, sunday.month_name) == (0, "Sun", "Jan")
    assert sunday.is_weekend and not sunday.is_business_day and sunday.days_from_today == -1
    assert (sunday.week_of_year, str(sunday.quarter_start), str(sunday.month_end)) == (1, "2026-01-01", "2026-01-31")


def test_calendar_has_every_day_of_six_years(frame):
    days = frame("activity_date string", ("2020-01-01",), ("2026-01-01",)).selectExpr("date(activity_date) activity_date")
    rows = [r.date_day for r in marts.date_spine(days).collect()]
    assert rows == [date(2019, 12, 2) + timedelta(days=i) for i in range(2253)]
    assert rows[-1] == date(2026, 1, 31)


def test_calendar_of_nothing_is_empty(spark):
    assert marts.date_spine(spark.createDataFrame([], "activity_date date")).count() == 0


# --- helpers, worksheet ------------------------------------------------------


@pytest.mark.parametrize(
    "unit, start, end, expected",
    [
        ("MINUTE", "2026-01-01 00:00:59", "2026-01-01 00:01:01", 1),
        ("MINUTE", "2026-01-01 00:00:00", "2026-01-01 00:00:59", 0),
        ("MINUTE", "2026-01-01 00:01:00", "2026-01-01 00:00:59", -1),
        ("HOUR", "2026-01-01 10:59:59", "2026-01-02 11:00:00", 25),
        ("HOUR", None, "2026-01-02 11:00:00", None),
    ],
)
def test_boundary_diff(frame, unit, start, end, expected):
    df = frame("a timestamp, b timestamp", (start, end))
    assert df.select(boundary_diff(unit, F.col("a"), F.col("b"))).first()[0] == expected


def test_percentage(frame):
    df = frame("a int, b int", (1, 2), (0, 0), (0, 5), (None, 1))
    assert [r[0] for r in df.select(percentage(F.col("a"), F.col("b"))).collect()] == [33.33, None, 0.0, None]


def test_worksheet_ranks_unknown_days_first(frame):
    rows = frame(GPS, *[("v", "d", 45.5, -73.6, 1.0, t, LOADED) for t in ("2026-01-01 10:00:00", None)])
    assert [r.event_date for r in worksheet.gps_events_per_day(rows).collect()] == [None, date(2026, 1, 1)]
    assert worksheet.gps_events_per_day(rows, days=1).count() == 1


def test_driver_status_counts_the_latest(frame):
    rows = frame(
        DRIVER,
        ("d1", "v", "online", "2026-01-01 10:00:00", LOADED),
        ("d1", "v", "offline", "2026-01-01 11:00:00", LOADED),
        ("d2", "v", "offline", "2026-01-01 09:00:00", LOADED),
    )
    assert [tuple(r) for r in worksheet.driver_status_counts(rows).collect()] == [("offline", 2)]
