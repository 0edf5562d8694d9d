"""Facts that are refreshed by change against facts that are built anew."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from convoy.plans import marts as M
from convoy.plans import staging as S
from convoy.plans.jobs import GateFailed
from convoy.plans.refresh import read_fact, read_version, refresh_facts
from convoy.schemas import RAW_SCHEMAS
from convoy.sources.load import read_raw

START = datetime(2026, 1, 1, 6)


def load(spark, raw, batch, **tables):
    for name, rows in tables.items():
        stamp = START + timedelta(days=90, hours=batch)
        full = [(*r, stamp) for r in rows]
        df = spark.createDataFrame(full, RAW_SCHEMAS[name]).coalesce(1)
        df.write.mode("overwrite").parquet(f"{raw}/{name}/generation=0/load_batch={batch}")


def gps(vehicle, hours, speed=30.0, driver="d1"):
    return (vehicle, driver, 45.5, -73.6, speed, START + timedelta(hours=hours))


def step(package, status, hours, vehicle="v1", order=None):
    return (package, order or f"o-{package}", vehicle, None, status, START + timedelta(hours=hours))


def order(package, hours):
    return (f"o-{package}", package, "created", START + timedelta(hours=hours))


def takes(driver, vehicle, hours, status="online"):
    return (driver, vehicle, status, START + timedelta(hours=hours))


def built_anew(spark, raw):
    tables = {t: read_raw(spark, raw, t) for t in RAW_SCHEMAS}
    staged = S.staging_tables(tables)
    gps_days, steps = M.gps_day_rollup(staged["stg_gps_events"]), staged["stg_delivery_events"]
    return {
        "fct_daily_activity": M.fct_daily_activity(gps_days, steps),
        "fct_deliveries": M.fct_deliveries(steps, staged["stg_orders"], staged["stg_driver_events"]),
    }


def same(spark, raw, out):
    for name, want in built_anew(spark, raw).items():
        got = read_fact(spark, out, name)
        assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect())), name


def files(out):
    return {str(f) for f in Path(out).glob("fct_*/run=*/*/*.parquet")}


def test_what_a_load_changes_and_nothing_else(spark, tmp_path):
    """Late positions and steps, orders that come after their packages, drivers loaded late and again on another
    vehicle, a package that moves to an earlier day: after each the facts equal a full build."""
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    load(
        spark, raw, 0,
        gps_events=[gps("v1", 1), gps("v2", 30), gps("v1", 55)],
        delivery_events=[step("a", "picked_up", 2), step("a", "delivered", 3), step("b", "picked_up", 30, "v2"),
                         step("c", "picked_up", 54), step("c", "failed", 56)],
        orders=[order("a", 1)],
        driver_events=[takes("d1", "v1", 0), takes("d2", "v2", 29)],
    )
    assert refresh_facts(spark, raw, out) == {
        "fct_daily_activity": ["2026-01-01", "2026-01-02", "2026-01-03"],
        "fct_deliveries": ["2026-01-01", "2026-01-02", "2026-01-03"],
    }
    same(spark, raw, out)
    before, held = read_version(spark, out)["days"], files(out)
    assert refresh_facts(spark, raw, out) == {"fct_daily_activity": [], "fct_deliveries": []}
    assert files(out) == held

    load(spark, raw, 1, gps_events=[gps("v9", 2), gps("v1", 1, 90.0)], orders=[order("b", 28)])
    assert refresh_facts(spark, raw, out) == {"fct_daily_activity": ["2026-01-01"], "fct_deliveries": ["2026-01-02"]}
    same(spark, raw, out)
    now = read_version(spark, out)["days"]
    assert now["fct_daily_activity"]["2026-01-03"] == before["fct_daily_activity"]["2026-01-03"]
    assert now["fct_deliveries"]["2026-01-01"] == before["fct_deliveries"]["2026-01-01"] and held <= files(out)

    load(spark, raw, 2, driver_events=[takes("d3", "v1", 53), takes("d1", "v2", 0)])
    assert refresh_facts(spark, raw, out)["fct_daily_activity"] == []
    same(spark, raw, out)

    load(spark, raw, 3, delivery_events=[step("c", "in_transit", 25), step("d", "delivered", 80), step("a", "failed", 4)])
    refresh_facts(spark, raw, out)
    same(spark, raw, out)
    assert set(read_version(spark, out)["days"]["fct_deliveries"]) == {"2026-01-01", "2026-01-02", "2026-01-04"}


def test_random_loads(spark, tmp_path):
    rng = random.Random(6)
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    statuses = ["picked_up", "in_transit", "delivered", "failed", "created"]
    for batch in range(2):
        load(
            spark, raw, batch,
            gps_events=[gps(f"v{rng.randrange(4)}", rng.randrange(120), float(rng.randrange(-5, 90))) for _ in range(40)],
            delivery_events=[step(f"p{rng.randrange(25)}", rng.choice(statuses), rng.randrange(120), f"v{rng.randrange(4)}") for _ in range(40)],
            orders=[order(f"p{rng.randrange(25)}", rng.randrange(60)) for _ in range(8)],
            driver_events=[takes(f"d{rng.randrange(5)}", f"v{rng.randrange(4)}", rng.randrange(120)) for _ in range(6)],
        )
        refresh_facts(spark, raw, out)
    same(spark, raw, out)


def test_a_failed_gate_and_a_full_reload(spark, tmp_path, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    empty = {"gps_events": [], "orders": [], "driver_events": []}
    load(spark, raw, 0, delivery_events=[step("a", "picked_up", 2)], **empty)
    refresh_facts(spark, raw, out)
    load(spark, raw, 1, delivery_events=[step("b", "picked_up", 2)])

    def failing(stage, tables):
        raise GateFailed(stage, [])

    monkeypatch.setattr("convoy.plans.refresh.gate", failing)
    with pytest.raises(GateFailed):
        refresh_facts(spark, raw, out)
    assert read_fact(spark, out, "fct_deliveries").count() == 1
    monkeypatch.undo()
    refresh_facts(spark, raw, out)
    same(spark, raw, out)
    # a new generation of the steps that has one package only
    rows = spark.createDataFrame([(*step("z", "failed", 9), START)], RAW_SCHEMAS["delivery_events"])
    rows.write.parquet(f"{raw}/delivery_events/generation=1/load_batch=0")
    ended = spark.createDataFrame([(1,)], "generation int")
    ended.write.parquet(f"{raw}/_generations/delivery_events/ended=1")
    refresh_facts(spark, raw, out)
    same(spark, raw, out)
    assert [r.package_id for r in read_fact(spark, out, "fct_deliveries").collect()] == ["z"]


def test_untouched_days_are_not_scanned(spark, tmp_path):
    """The days of a load reach the scan of RAW as bounds of the time."""
    from convoy.plans.refresh import _on, raw_batches

    raw = str(tmp_path / "raw")
    load(spark, raw, 0, gps_events=[gps("v1", 1)])
    rows = _on(raw_batches(spark, raw, "gps_events", 0), [START.date()]).select(F.count("*"))
    assert "GreaterThanOrEqual(event_time" in rows._jdf.queryExecution().toString()


def test_raw_is_staged_once_for_the_delivery_fact(spark, tmp_path):
    """The as-of join reads stored steps and drivers; of RAW only the orders, which it needs once, are left in the plan."""
    from convoy.plans.refresh import deliveries_of, raw_batches

    raw = str(tmp_path / "raw")
    load(
        spark, raw, 0, gps_events=[], orders=[order("a", 1)],
        delivery_events=[step("a", "picked_up", 2), step("b", "picked_up", 3)], driver_events=[takes("d1", "v1", 0)],
    )
    every = {t: raw_batches(spark, raw, t, 0) for t in RAW_SCHEMAS}
    for packages, want in [(None, ["a", "b"]), (spark.createDataFrame([("a",)], "package_id string"), ["a"])]:
        fact = deliveries_of(every, packages)
        assert {f.split("/generation=0/")[0].split("/")[-1] for f in fact.inputFiles() if raw in f} == {"orders"}
        rows = fact.orderBy("package_id").collect()
        assert [(r.package_id, r.driver_id) for r in rows] == [(p, "d1") for p in want]
