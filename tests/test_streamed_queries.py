"""Registered queries over small events of odd shapes."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import streams as queries
from checks.fleet import topic_records
from checks.queries import fleet_metrics
from convoy.schemas import ORDER_TOPIC, RAW_SCHEMAS

START = datetime(2026, 1, 1)


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with events whose ids and times are given as offsets in seconds."""

    def make(*events):
        rows = [(i, START + timedelta(seconds=s), i, "view", 30.0 + i) for i, s in events]
        events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
        events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
        return str(tmp_path)

    return make


@pytest.mark.parametrize("query", [queries.stream_dedup, queries.stream_first_arrivals])
def test_steps_of_one_package_at_one_instant_are_no_repeats(spark, tables, query):
    # four steps of package 1 at one time, others around them so that every piece has some
    folder = tables((1, 0), (4, 5000), (5, 5000), (6, 5000), (7, 5000), (9, 10000))
    rows = query(spark, folder).filter(F.col("package_id") == "pkg-1").collect()
    assert sorted(r.status for r in rows) == ["created", "delivered", "in_transit", "picked_up"]


def test_records_of_one_row_group_are_made_by_many_tasks(spark, tables):
    folder = tables(*[(i, i) for i in range(200)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records = topic_records(spark, folder, ORDER_TOPIC)
        assert records.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _recorded(monkeypatch, module, name, seen):
    before = getattr(module, name)

    def call(rows, *more):
        seen.append(rows.inputFiles())
        return before(rows, *more)

    monkeypatch.setattr(module, name, call)


def _computed_before(files):
    """None of the files is the table of events: the rows were stored."""
    return bool(files) and all("events.parquet" not in f for f in files)


def test_records_held_back_by_their_content_are_made_once(spark, tables, monkeypatch):
    folder, seen = tables((1, 0), (2, 40_000), (3, 80_000), (4, 120_000)), []
    _recorded(monkeypatch, queries, "pieces", seen)
    assert queries.stream_ordered(spark, folder).count() == 4
    assert all(map(_computed_before, seen))


def test_the_lake_is_cut_from_rows_that_are_computed_once(spark, tables, monkeypatch):
    folder, cut, enriched = tables((1, 0), (2, 40_000), (3, 80_000)), [], []
    _recorded(monkeypatch, queries, "pieces", cut)
    _recorded(monkeypatch, queries, "enrich_gps", enriched)
    queries._lake_in_two_steps(spark, folder, "held", load=False)
    assert len(cut) == 4 and len(enriched) == 1 and all(map(_computed_before, cut + enriched))


def test_gauges_parse_positions_before_they_are_enriched(spark, tables, monkeypatch):
    from checks import queries as batch

    folder, seen = tables((1, 0), (2, 40), (3, 80)), []
    _recorded(monkeypatch, batch.enrich, "enrich_gps", seen)
    fleet_metrics(spark, folder).collect()
    assert len(seen) == 1 and _computed_before(seen[0])


def test_every_row_is_sent_with_one_load(spark, tmp_path):
    """Rows without a load time come with the first load; a table without rows brings no load."""
    rows = [(f"o{i}", f"p{i}", "created", START, START + timedelta(days=i) if i else None) for i in range(7)]
    raw = {
        "orders": spark.createDataFrame(rows, RAW_SCHEMAS["orders"]),
        "driver_events": spark.createDataFrame([], RAW_SCHEMAS["driver_events"]),
    }
    queries.send_loads(raw, str(tmp_path))
    sent = spark.read.parquet(str(tmp_path / "orders"))
    loads = {r.order_id: r.load_batch for r in sent.collect()}
    assert loads == {"o0": 0, "o1": 0, "o2": 0, "o3": 1, "o4": 1, "o5": 2, "o6": 2}
    assert not list((tmp_path / "driver_events").glob("load_batch=*"))
    assert sorted(r.order_id for p in queries.pieces(raw["orders"], "load_timestamp") for r in p.collect()) == sorted(loads)
