import pytest
from pyspark.sql import functions as F

from convoy.plans import gauges, quality, state

GPS = "vehicle_id string, driver_id string, lat double, lon double, speed_kmh double"
NOW = "2026-01-02 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def failed(df, event_type):
    return {(r.expectation, r.column) for r in quality.validate(df, event_type).collect() if not r.success}


def test_good_positions_pass(frame):
    rows = frame(GPS, ("v", "d", 45.0, -74.5, 0.0), ("v", "d", 46.5, -73.0, None))
    results = quality.validate(rows, "gps").collect()
    assert len(results) == 5 and all(r.success for r in results)


@pytest.mark.parametrize(
    "row, broken",
    [
        (("v", "d", 48.85, -73.6, 1.0), ("between", "lat")),
        (("v", "d", 45.5, 2.35, 1.0), ("between", "lon")),
        (("v", "d", 45.5, -73.6, -1.0), ("between", "speed_kmh")),
        ((None, "d", 45.5, -73.6, 1.0), ("not_null", "vehicle_id")),
    ],
)
def test_bad_positions_fail(frame, row, broken):
    assert failed(frame(GPS, row), "gps") == {broken}


def test_bad_statuses_fail(frame):
    delivery = frame("package_id string, order_id string, vehicle_id string, status string", ("p", "o", "v", "livré"))
    assert failed(delivery, "delivery") == {("in_set", "status")}
    driver = frame("driver_id string, vehicle_id string, status string", ("d", "v", "en_pause"), ("d", "v", None))
    assert failed(driver, "driver") == {("in_set", "status")}


def test_missing_column_fails(frame):
    assert failed(frame("order_id string, package_id string", ("o", "p")), "order") == {("in_set", "status")}


def test_suite_is_one_pass(frame):
    plan = quality.validate(frame(GPS, ("v", "d", 45.5, -73.6, 1.0)), "gps")
    text = plan._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("Scan") == 1


def test_scores(frame, spark):
    lake = {
        "gps": frame(GPS, ("v", "d", 45.5, -73.6, -1.0)),
        "delivery": spark.createDataFrame([], "package_id string, order_id string, vehicle_id string, status string"),
        "order": frame("order_id string, package_id string, status string", ("o", "p", "created")),
        "driver": frame("driver_id string, vehicle_id string, status string", ("d", None, "online")),
    }
    results = quality.quality_results(lake)
    scores = {r.scope: r for r in quality.quality_score(results).collect()}
    assert (scores["gps"].n_expectations, scores["gps"].quality_score) == (5, 80.0)
    assert (scores["delivery"].n_expectations, scores["delivery"].quality_score) == (0, 0.0)
    assert scores["order"].all_passed and not scores["delivery"].all_passed
    assert (scores["all"].n_expectations, scores["all"].n_success, scores["all"].quality_score) == (11, 9, 81.8)
    report, passed = quality.quality_report(results)
    assert not passed and "score 81.8% (9/11 checks)" in report


def test_there_are_41_table_tests():
    counts = [len(t.checks) + len(t.unique) for t in quality.TABLE_TESTS.values()]
    assert sum(counts) == 41
    assert sum(len(s) for s in quality.SUITES.values()) == 15


def test_table_tests_find_failures(frame):
    rows = frame(
        "driver_id string, current_status string", ("a", "online"), ("a", "asleep"), (None, None), ("b", "offline")
    )
    found = {(r.test, r.column): r.n_failing for r in quality.run_table_tests("dim_drivers", rows).collect()}
    assert found == {
        ("not_null", "driver_id"): 1,
        ("not_null", "current_status"): 1,
        ("in_set", "current_status"): 1,
        ("unique", "driver_id"): 1,
    }


# --- gauges ------------------------------------------------------------------

LAKE_GPS = GPS + ", event_time timestamp"


def values(df):
    return {(r.metric, r.label): r.value for r in df.collect()}


def test_lake_gauges_and_sentinels(frame, spark):
    rows = frame(LAKE_GPS, ("v", "d", 45.5, -73.6, 1.0, "2026-01-01 23:59:30")).withColumn(
        "anomaly_types", F.array(F.lit("IMMOBILE"), F.lit("GPS_JUMP"))
    )
    found = values(gauges.lake_gauges("gps", rows, now()))
    assert found[("delivery_lake_events_total", "gps")] == 1
    assert found[("delivery_lake_last_event_age_seconds", "gps")] == 30.0
    assert found[("delivery_lake_anomalies_total", "IMMOBILE")] == 1
    assert found[("delivery_lake_anomalies_total", "SPEED_TOO_HIGH")] == 0
    empty = spark.createDataFrame([], "event_time timestamp")
    assert values(gauges.lake_gauges("order", empty, now())) == {
        ("delivery_lake_events_total", "order"): 0,
        ("delivery_lake_last_event_age_seconds", "order"): -1,
    }


def test_driver_gauges(frame):
    rows = frame(
        "driver_id string, status string, event_time timestamp",
        ("d1", "online", "2026-01-01 10:00:00"),
        ("d1", "on_break", "2026-01-01 11:00:00"),
        ("d1", "offline", None),
        ("d2", "asleep", "2026-01-01 11:00:00"),
        (None, "online", "2026-01-01 11:00:00"),
    )
    found = values(gauges.driver_gauges(rows))
    assert [found[("delivery_drivers_by_status", s)] for s in ("offline", "online", "on_break", "delivering")] == [0, 0, 1, 0]


def test_all_gauges(frame, spark):
    lake = {
        "gps": frame(LAKE_GPS, ("v", "d", 45.5, -73.6, 30.0, "2026-01-01 10:00:00")),
        "delivery": spark.createDataFrame([], "package_id string, status string, event_time timestamp"),
        "order": spark.createDataFrame([], "order_id string, event_time timestamp"),
        "driver": spark.createDataFrame([], "driver_id string, status string, event_time timestamp"),
    }
    found = values(gauges.fleet_metrics(lake, state.vehicle_state(lake["gps"]), now()))
    assert found[("delivery_vehicles_tracked", None)] == 1 and found[("delivery_vehicles_avg_speed_kmh", None)] == 30
    assert found[("delivery_data_quality_score", None)] == 100 and found[("delivery_data_quality_score_by_type", "order")] == 0


# --- vehicle state -----------------------------------------------------------

POSITIONS = "vehicle_id string, driver_id string, lat double, lon double, speed_kmh double, event_time timestamp"


def test_state_is_the_latest_by_event_time(frame):
    rows = frame(
        POSITIONS,
        ("v1", "d2", 45.6, -73.6, None, "2026-01-01 11:00:00"),
        ("v1", "d1", 45.5, -73.6, 9.0, "2026-01-01 10:00:00"),
        ("v2", None, None, None, 50.0, None),
    )
    found = state.vehicle_state(rows)
    rows = {r.vehicle_id: r for r in found.collect()}
    assert (rows["v1"].driver_id, rows["v1"].speed_kmh) == ("d2", None)
    assert state.lookup_vehicle(found, "v1").count() == 1
    assert state.lookup_vehicle(found, "nobody").count() == 0
    assert state.tracked_vehicles(found).count() == 2
    assert tuple(state.fleet_speed(found).first()) == (2, 50.0)


def test_state_as_text_and_back(frame):
    rows = frame(
        POSITIONS,
        ("v1", "d1", 45.5, None, 9.0, "2026-01-01 10:00:00"),
        ("v2", None, None, None, None, "2026-01-01 10:00:00.5"),
    )
    texts = {r.key: r for r in state.encode_state(state.vehicle_state(rows)).collect()}
    first, second = texts["vehicle:v1:state"], texts["vehicle:v2:state"]
    assert (first.driver_id, first.lat, first.lon, first.event_time) == ("d1", "45.5", "", "2026-01-01T10:00:00")
    assert (second.driver_id, second.event_time) == ("", "2026-01-01T10:00:00.500000")
    hashes = frame(
        "key string, driver_id string, lat string, lon string, speed_kmh string, event_time string",
        ("vehicle:v:state", "", "45.5", "x", "", ""),
    )
    assert tuple(state.decode_state(hashes).first()) == ("v", None, 45.5, None, None, None)


def test_state_expires(frame):
    rows = frame(POSITIONS, *[(v, "d", 45.5, -73.6, 1.0, t) for v, t in (("old", "2026-01-01 00:00:00"), ("new", "2026-01-01 00:00:01"))])
    assert [r.vehicle_id for r in state.live_state(state.vehicle_state(rows), now()).collect()] == ["new"]


def test_empty_state(spark):
    rows = spark.createDataFrame([], POSITIONS)
    assert tuple(state.fleet_speed(state.vehicle_state(rows)).first()) == (0, 0.0)
