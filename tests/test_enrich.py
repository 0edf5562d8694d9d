import pytest
from pyspark.sql import functions as F

from convoy.functions import haversine_km
from convoy.plans import enrich

POINTS = "vehicle_id string, lat double, lon double, event_time timestamp"
MEASURED = "vehicle_id string, speed_kmh double, computed_speed_kmh double, distance_km double, is_immobile boolean"


def by_time(df):
    return enrich.add_movement_metrics(df).orderBy("vehicle_id", "event_time").collect()


def test_first_point_has_no_metrics(frame):
    row = by_time(frame(POINTS, ("v", 45.5, -73.6, "2026-01-01 10:00:00")))[0]
    assert row.distance_km is None and row.computed_speed_kmh is None and row.is_immobile is None


def test_moving(frame):
    rows = by_time(
        frame(
            POINTS,
            ("v", 45.5, -73.6, "2026-01-01 10:00:00"),
            ("v", 45.501, -73.599, "2026-01-01 10:00:02"),
        )
    )
    assert rows[1].distance_km > 0 and rows[1].elapsed_seconds == 2 and rows[1].is_immobile is False


def test_standing(frame):
    rows = by_time(
        frame(POINTS, ("v", 45.5, -73.6, "2026-01-01 10:00:00"), ("v", 45.5, -73.6, "2026-01-01 10:00:02"))
    )
    assert rows[1].distance_km == 0.0 and rows[1].is_immobile is True


def test_vehicles_do_not_mix(frame):
    rows = by_time(
        frame(
            POINTS,
            ("veh-1", 45.5, -73.6, "2026-01-01 10:00:00"),
            ("veh-1", 45.6, -73.6, "2026-01-01 10:00:02"),
            ("veh-2", 45.7, -73.6, "2026-01-01 10:00:01"),
        )
    )
    assert rows[2].vehicle_id == "veh-2" and rows[2].distance_km is None


def test_less_than_a_whole_second_gives_no_speed(frame):
    rows = by_time(
        frame(
            POINTS,
            ("v", 45.5, -73.6, "2026-01-01 10:00:00.1"),
            ("v", 45.6, -73.6, "2026-01-01 10:00:00.9"),
        )
    )
    assert rows[1].elapsed_seconds == 0 and rows[1].computed_speed_kmh is None
    assert rows[1].is_immobile is None


def test_unknown_coordinates_and_times(frame):
    rows = by_time(
        frame(
            POINTS,
            ("v", 45.5, -73.6, None),
            ("v", None, None, "2026-01-01 10:00:00"),
            ("v", 45.5, -73.6, "2026-01-01 10:00:02"),
        )
    )
    assert [r.distance_km for r in rows] == [None, None, None]
    assert [r.elapsed_seconds for r in rows] == [None, None, 2]


@pytest.mark.parametrize(
    "declared, computed, km, immobile, expected",
    [
        (30.0, 32.0, 0.02, False, []),
        (30.0, 200.0, 0.11, False, ["SPEED_TOO_HIGH", "SPEED_MISMATCH"]),
        (30.0, 90.0, 0.05, False, ["SPEED_MISMATCH"]),
        (0.0, 0.0, 0.0, True, ["IMMOBILE"]),
        (30.0, 40.0, 3.5, False, ["GPS_JUMP"]),
        (0.0, 500.0, 9.0, True, ["SPEED_TOO_HIGH", "SPEED_MISMATCH", "IMMOBILE", "GPS_JUMP"]),
        (80.0, 130.0, 2.0, False, []),
        (None, 100.0, None, None, []),
        (None, None, None, None, []),
    ],
)
def test_anomalies(frame, declared, computed, km, immobile, expected):
    row = enrich.add_anomaly_flags(frame(MEASURED, ("v", declared, computed, km, immobile))).first()
    assert row.anomaly_types == expected
    assert row.is_anomaly is bool(expected)


def test_haversine(spark):
    def km(*p):
        return spark.range(1).select(haversine_km(*[F.lit(x) for x in p])).first()[0]

    assert km(45.5, -73.6, 45.5, -73.6) == 0.0
    assert abs(km(45.0, -73.6, 46.0, -73.6) - 111) < 1
    assert km(45.5, -73.6, 45.9, -73.1) == pytest.approx(km(45.9, -73.1, 45.5, -73.6))
    assert abs(km(0.0, 0.0, 0.0, 180.0) - 20015) < 1
    assert km(None, 0.0, 0.0, 0.0) is None


def test_enrichment_runs_without_python_workers(frame):
    plan = enrich.enrich_gps(
        frame(POINTS + ", speed_kmh double", ("v", 1.0, 1.0, "2026-01-01 10:00:00", 1.0))
    )._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "BatchEval" not in plan
