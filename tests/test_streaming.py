import json
import os
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from convoy.plans import ingest, jobs
from convoy.plans.enrich import enrich_gps
from convoy.schemas import DELIVERY_TOPIC, GPS_TOPIC, ORDER_TOPIC
from convoy.session import work_folder
from convoy.sources import load, manifest
from convoy.sources.lake import dead_letter_path, file_inventory, lake_path
from convoy.sources.load import load_events, read_load_audit, read_raw
from convoy.sources.manifest import read_lake
from convoy.sources.topics import read_topic_files
from convoy.streaming import jobs as streams
from convoy.streaming import ordered, sinks
from convoy.streaming.enrich import mend_lake
from convoy.streaming.layout import Layout

START = datetime(2026, 1, 1, 9, 58)


@pytest.fixture
def layout(tmp_path):
    return Layout([str(tmp_path / "lake")], str(tmp_path))


@pytest.fixture
def send(spark, tmp_path):
    """Append payloads to a topic as one file of records; returns the topic as a stream."""
    sent = {}

    def go(topic, *payloads, files_per_trigger=None):
        folder = str(tmp_path / "topics" / topic)
        first = sent.get(topic, 0)
        sent[topic] = first + len(payloads)
        rows = [
            (p if isinstance(p, str) else json.dumps(p), topic, 0, first + i)
            for i, p in enumerate(payloads)
        ]
        if rows:
            (
                spark.createDataFrame(rows, "text string, topic string, partition int, offset bigint")
                .select(
                    F.lit("k").cast("binary").alias("key"),
                    F.col("text").cast("binary").alias("value"),
                    "topic",
                    "partition",
                    "offset",
                    (F.lit(START) + F.make_dt_interval(secs=F.col("offset"))).alias("timestamp"),
                )
                .coalesce(1)
                .write.mode("append")
                .parquet(folder)
            )
        return read_topic_files(spark, folder, files_per_trigger)

    return go


def position(i, vehicle="v", seconds=None, **more):
    time = START + timedelta(seconds=i * 40 if seconds is None else seconds)
    return {
        "vehicle_id": vehicle,
        "driver_id": "d",
        "lat": 45.5 + 0.001 * (i % 17),
        "lon": -73.6 + 0.001 * (i % 5),
        "speed_kmh": 30.0,
        "timestamp": time.isoformat() + "+00:00",
        **more,
    }


def clean(stream, topic=GPS_TOPIC):
    return ingest.topic_pipeline(stream, topic)[0]


def run(query):
    for q in query if isinstance(query, list) else [query]:
        q.awaitTermination()
        assert q.exception() is None


METRICS = ["vehicle_id", "event_time", "prev_lat", "prev_lon", "prev_event_time", "distance_km", "elapsed_seconds", "is_immobile"]


def metrics(df):
    return sorted(map(str, df.select(*METRICS, F.array_join("anomaly_types", ",")).collect()))


@pytest.mark.parametrize("pieces", [1, 2, 5])
def test_batch_boundaries_do_not_matter(spark, send, layout, pieces):
    """1, 2 or 5 micro-batches over hour marks give what one pass over the history gives."""
    events = [position(i, vehicle=f"v{i % 2}") for i in range(20)]
    size = len(events) // pieces
    for i in range(pieces):
        stream = send(GPS_TOPIC, *events[i * size : (i + 1) * size], files_per_trigger=1)
    run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    records = spark.read.parquet(str(layout.work) + f"/topics/{GPS_TOPIC}")
    assert metrics(read_lake(spark, layout.lakes[0], "gps")) == metrics(enrich_gps(clean(records)))


def test_without_carry_every_batch_starts_anew(spark, send, layout):
    for i in range(3):
        stream = send(GPS_TOPIC, position(i), files_per_trigger=1)
    run(sinks.write_enriched_lake(clean(stream), layout, carry=False, available_now=True))
    rows = read_lake(spark, layout.lakes[0], "gps")
    assert rows.count() == 3 and rows.filter("distance_km is not null").count() == 0


def test_restart_adds_nothing(spark, send, layout):
    stream = send(GPS_TOPIC, position(0), position(1))
    for _ in range(2):
        run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    assert read_lake(spark, layout.lakes[0], "gps").count() == 2


def test_late_position_is_not_a_predecessor(spark, send, layout):
    stream = send(GPS_TOPIC, position(10))
    run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    stream = send(GPS_TOPIC, position(5), position(12))
    run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    rows = {r.event_time: r for r in read_lake(spark, layout.lakes[0], "gps").collect()}
    assert len(rows) == 3
    newest, late = rows[START + timedelta(seconds=480)], rows[START + timedelta(seconds=200)]
    assert newest.prev_event_time == START + timedelta(seconds=400)
    assert late.prev_event_time is None


def test_mended_days_equal_one_pass(spark, send, layout):
    """Two days; a late position on the first, one before all others, and one without a time."""
    day = 24 * 3600
    seconds = [0, 400, 800, day, day + 400]
    stream = send(GPS_TOPIC, *[position(i, seconds=s) for i, s in enumerate(seconds)])
    run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    late = [position(7, seconds=600), position(8, seconds=day + 200), position(9, timestamp="x")]
    stream = send(GPS_TOPIC, *late)
    run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    records = spark.read.parquet(f"{layout.work}/topics/{GPS_TOPIC}")
    want = metrics(enrich_gps(clean(records)))
    assert metrics(read_lake(spark, layout.lakes[0], "gps")) != want
    for _ in range(2):
        mend_lake(spark, layout.lakes[0], START.date())
        assert metrics(read_lake(spark, layout.lakes[0], "gps")) == want


def test_a_replayed_batch_replaces_itself(spark, send, layout):
    """foreachBatch may see a batch again after a failure."""
    stream = send(GPS_TOPIC, position(0), position(1))
    batch = clean(spark.read.parquet(f"{layout.work}/topics/{GPS_TOPIC}"))
    write = sinks._enrich_and_store(layout, carry=True)
    for _ in range(2):
        write(batch, 0)
    for _ in range(2):
        write(clean(spark.read.parquet(f"{layout.work}/topics/{GPS_TOPIC}")).filter("false"), 1)
    assert stream.isStreaming and read_lake(spark, layout.lakes[0], "gps").count() == 2


def test_positions_without_time_survive(spark, send, layout):
    stream = send(GPS_TOPIC, position(0, timestamp="x"), position(1))
    run(sinks.write_enriched_lake(clean(stream), layout, available_now=True))
    rows = read_lake(spark, layout.lakes[0], "gps")
    assert rows.count() == 2 and rows.filter("event_date is null").count() == 1


def step(package, status, i, **more):
    time = (START + timedelta(minutes=i)).isoformat() + "+00:00"
    return {"package_id": package, "order_id": "o", "vehicle_id": "v", "status": status, "timestamp": time, **more}


def test_native_lake_sink_and_dual_write(spark, send, tmp_path):
    layout = Layout([str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path))
    stream = send(DELIVERY_TOPIC, step("p1", " Picked_Up ", 0), step("p2", "failed", 1))
    queries = sinks.write_lake(clean(stream, DELIVERY_TOPIC), "delivery", layout, "lake_delivery", True)
    assert [q.name for q in queries] == ["lake_delivery", "lake_delivery_1"]
    run(queries)
    for root in layout.lakes:
        rows = read_lake(spark, root, "delivery")
        assert sorted(r.status for r in rows.collect()) == ["failed", "picked_up"]
        assert {(str(r.event_date), r.event_type) for r in rows.collect()} == {("2026-01-01", "delivery")}


def test_one_query_per_topic_writes_everything(spark, send, tmp_path):
    layout = Layout([str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path))
    sources = {
        GPS_TOPIC: send(GPS_TOPIC, position(0), position(1), position(2, vehicle=None)),
        ORDER_TOPIC: send(ORDER_TOPIC, {"order_id": "o", "package_id": "p", "status": "created"}, "{broken"),
    }
    run(streams.start_topics(sources, layout, available_now=True))
    for root in layout.lakes:
        assert read_lake(spark, root, "gps").filter("distance_km > 0").count() == 1
        assert read_lake(spark, root, "order").count() == 1
        dead = spark.read.parquet(dead_letter_path(root))
        assert {(r.reject_topic, r.reject_reason) for r in dead.collect()} == {
            (GPS_TOPIC, "missing_required_key"),
            (ORDER_TOPIC, "missing_required_key"),
        }
    assert sinks.vehicle_states(layout).latest(spark).count() == 1


def files_below(path):
    return len(list(Path(path).rglob("*.parquet")))


def test_readers_of_compacted_days_see_old_or_new(spark, send, layout):
    """Readers built before, between writing and switching, and after; late batches; vacuum; a second compaction."""
    lake = layout.lakes[0]

    def go(*events):
        stream = send(DELIVERY_TOPIC, *events)
        run(sinks.write_topic(stream, DELIVERY_TOPIC, layout, "lake_delivery", True))

    def packages():
        return sorted(r.package_id for r in read_lake(spark, lake, "delivery").collect())

    for i in range(4):
        go(step(f"p{i}", "failed", i), step(f"q{i}", "failed", 24 * 60 + i), step(f"r{i}", "failed", i, timestamp="x"))
    want = packages()
    assert len(want) == 12
    old_reader = read_lake(spark, lake, "delivery")
    broken_off = manifest.write_file
    manifest.write_file = lambda *a: (_ for _ in ()).throw(OSError("lost"))
    try:
        with pytest.raises(OSError):
            manifest.compact(spark, lake, "delivery")
    finally:
        manifest.write_file = broken_off
    assert packages() == want
    assert manifest.compact(spark, lake, "delivery") == ["2026-01-01", "2026-01-02", manifest.NO_DAY]
    assert packages() == want and manifest.compact(spark, lake, "delivery") == []
    assert sorted(r.package_id for r in old_reader.collect()) == want
    run_files = files_below(f"{lake}/compacted/delivery")
    assert run_files < files_below(f"{lake}/events/delivery")
    go(step("late", "failed", 1))
    go(step("later", "failed", 2))
    want = sorted([*want, "late", "later"])
    assert packages() == want
    loaded = spark.createDataFrame([], "file_path string")
    assert manifest.vacuum(spark, lake, "delivery", loaded) == 0 and packages() == want
    assert manifest.vacuum(spark, lake, "delivery") == 12 and packages() == want
    assert manifest.compact(spark, lake, "delivery", before="2026-01-02") == ["2026-01-01"]
    assert packages() == want
    manifest.vacuum(spark, lake, "delivery")
    assert packages() == want and files_below(f"{lake}/events/delivery") == 0
    # a repeat is still known from the compacted day
    stream = send(DELIVERY_TOPIC, step("p0", "failed", 0), step("new", "failed", 3))
    once = clean(stream, DELIVERY_TOPIC)
    run(sinks.write_once(once, "delivery", ["package_id", "event_time"], layout, "once", True))
    assert packages() == sorted([*want, "new"])


def test_two_maintainers_do_not_overwrite_each_other(spark, send, layout):
    stream = send(DELIVERY_TOPIC, step("a", "failed", 0))
    run(sinks.write_topic(stream, DELIVERY_TOPIC, layout, "lake_delivery", True))
    lake = layout.lakes[0]
    at = manifest.read_manifest(spark, lake, "delivery")
    assert manifest.compact(spark, lake, "delivery", at_least=1) == ["2026-01-01"]
    rows = read_lake(spark, lake, "delivery")
    with pytest.raises(RuntimeError):
        manifest.switch_days(spark, lake, "delivery", rows, {"2026-01-01"}, [], at)


def test_a_batch_lost_between_two_targets_ends_in_both(spark, send, tmp_path, monkeypatch):
    layout = Layout([str(tmp_path / "a"), str(tmp_path / "b")], str(tmp_path))
    write, lost = sinks._append_batch, []

    def failing(rows, path, *more):
        if path.startswith(str(tmp_path / "b")) and not lost:
            lost.append(path)
            raise OSError("lost")
        return write(rows, path, *more)

    monkeypatch.setattr(sinks, "_append_batch", failing)
    stream = send(DELIVERY_TOPIC, *[step(f"p{i}", "failed", i) for i in range(5)])
    query = sinks.write_topic(stream, DELIVERY_TOPIC, layout, "lake_delivery", True)
    with pytest.raises(Exception, match="lost"):
        query.awaitTermination()
    assert read_lake(spark, layout.lakes[1], "delivery").count() == 0
    run(sinks.write_topic(stream, DELIVERY_TOPIC, layout, "lake_delivery", True))
    both = [sorted(map(str, read_lake(spark, root, "delivery").collect())) for root in layout.lakes]
    assert both[0] == both[1] and len(both[0]) == 5
    (record,) = Path(layout.commits("events")).glob("writer=*/batch=0")
    assert record.read_text().split() == layout.events("delivery")


def test_vehicle_state_over_batches(spark, send, layout):
    stream = send(GPS_TOPIC, position(1, vehicle="a"), position(5, vehicle="b"))
    run(sinks.write_vehicle_state(clean(stream), layout, available_now=True))
    stream = send(GPS_TOPIC, position(3, vehicle="a"), position(2, vehicle="b"), position(0, vehicle="c"))
    run(sinks.write_vehicle_state(clean(stream), layout, available_now=True))
    found = {r.vehicle_id: r.event_time for r in sinks.vehicle_states(layout).latest(spark).collect()}
    assert found == {v: START + timedelta(seconds=40 * i) for v, i in (("a", 3), ("b", 5), ("c", 0))}


def test_expired_vehicles_leave_the_state(spark, send, layout):
    stream = send(GPS_TOPIC, position(1))
    run(sinks.write_vehicle_state(clean(stream), layout, ttl_seconds=0, available_now=True))
    assert sinks.vehicle_states(layout, ttl_seconds=0).latest(spark).count() == 0


def test_repeats_are_dropped_across_batches(spark, send, layout):
    for _ in range(2):
        stream = send(DELIVERY_TOPIC, step("p1", "failed", 0), step("p1", "failed", 0), step("p1", "delivered", 1))
        steps = clean(stream, DELIVERY_TOPIC)
        run(sinks.write_once(steps, "delivery", ["package_id", "event_time"], layout, "once", True))
    assert read_lake(spark, layout.lakes[0], "delivery").count() == 2


def test_late_and_untimed_events_are_no_repeats(spark, send, layout):
    untimed = step("p1", "failed", 0, timestamp="x")
    parts = [[step("a", "failed", 0)], [step("b", "failed", 600), untimed], [step("late", "failed", 1)]]
    for part in parts:
        stream = send(DELIVERY_TOPIC, *part)
        once = clean(stream, DELIVERY_TOPIC)
        run(sinks.write_once(once, "delivery", ["package_id", "event_time"], layout, "once", True))
    rows = read_lake(spark, layout.lakes[0], "delivery").collect()
    assert sorted(r.package_id for r in rows) == ["a", "b", "late", "p1"]


def test_two_checkpoints_write_into_one_lake(spark, send, tmp_path):
    lake = str(tmp_path / "lake")
    for work, vehicles in (("w1", "abc"), ("w2", "xy")):
        stream = send(GPS_TOPIC, *[position(0, vehicle=v) for v in vehicles])
        run(sinks.write_topic(stream, GPS_TOPIC, Layout([lake], str(tmp_path / work)), "lake_gps", True))
    rows = read_lake(spark, lake, "gps").collect()
    assert sorted(r.vehicle_id for r in rows) == sorted("abc" + "abcxy")


def test_readers_skip_a_half_written_state(spark, send, layout):
    stream = send(GPS_TOPIC, position(1, vehicle="a"), position(5, vehicle="b"))
    run(sinks.write_vehicle_state(clean(stream), layout, available_now=True))
    states = sinks.vehicle_states(layout)
    (changes,) = Path(states.path).glob("writer=*/changes")
    half = spark.read.parquet(f"{changes}/batch=0").limit(1).withColumn("vehicle_id", F.lit("half"))
    half.write.parquet(f"{changes}/batch=1")
    assert {r.vehicle_id for r in states.latest(spark).collect()} == {"a", "b", "half"}
    (changes / "batch=1/_SUCCESS").unlink()
    assert {r.vehicle_id for r in states.latest(spark).collect()} == {"a", "b"}
    later = F.current_timestamp() + F.expr("interval 2 days")
    assert states.latest(spark, as_of=later).count() == 0


def rows_in(spark, path):
    return spark.read.parquet(str(path)).count()


def test_a_batch_writes_the_vehicles_it_has_heard_of(spark, send, layout):
    stream = send(GPS_TOPIC, *[position(i, vehicle=f"v{i}") for i in range(50)])
    run(sinks.write_vehicle_state(clean(stream), layout, available_now=True))
    for i in range(3):
        stream = send(GPS_TOPIC, position(60 + i, vehicle="v7"), position(61 + i, vehicle="v7"))
        run(sinks.write_vehicle_state(clean(stream), layout, available_now=True))
    states = sinks.vehicle_states(layout)
    (changes,) = Path(states.path).glob("writer=*/changes")
    assert [rows_in(spark, changes / f"batch={i}") for i in range(4)] == [50, 1, 1, 1]
    found = {r.vehicle_id: r.event_time for r in states.latest(spark).collect()}
    assert len(found) == 50 and found["v7"] == START + timedelta(seconds=40 * 63)


def changed(spark, batch, *vehicles):
    now = datetime.now() if batch >= 0 else datetime.now() - timedelta(days=2)
    rows = [(v, "d", 45.5, -73.6, float(batch), START + timedelta(minutes=abs(batch)), now) for v in vehicles]
    return spark.createDataFrame(rows, sinks.VEHICLE_STATE)


def test_changes_are_folded_and_expired_vehicles_leave(spark, tmp_path):
    """A state folded every 3 batches equals one never folded; replays and both kinds of readers included."""
    plain = sinks.VehicleStates(str(tmp_path / "plain"), fold_every=10_000)
    folded = sinks.VehicleStates(str(tmp_path / "folded"), fold_every=3)
    for state in (plain, folded):
        state.write(changed(spark, -1, "old", "a"), 0, "w")
    for n in range(1, 9):
        for state in (plain, folded):
            for _ in range(1 + n % 2):
                state.write(changed(spark, n, "a" if n % 2 else "b", f"v{n}"), n, "w")
        live = sorted(map(str, plain.latest(spark).drop("updated_at").collect()))
        assert sorted(map(str, folded.latest(spark).drop("updated_at").collect())) == live
        assert sorted(map(str, folded.before(spark, n + 1, "w").filter("vehicle_id <> 'old'").drop("updated_at").collect())) == live
    root = tmp_path / "folded/writer=w"
    assert sorted(f.name for f in (root / "folded").glob("upto=*")) == ["upto=5", "upto=8"]
    assert sorted(f.name for f in (root / "changes").glob("batch=*")) == ["batch=6", "batch=7", "batch=8"]
    assert "old" not in {r.vehicle_id for r in spark.read.parquet(str(root / "folded/upto=8")).collect()}


@pytest.mark.parametrize("pieces", [1, 4])
def test_out_of_order_arrival_gives_what_one_pass_gives(spark, send, layout, pieces):
    """Positions arrive shuffled, within the delay, in any number of batches: no later correction is needed."""
    layout = Layout(layout.lakes, layout.work, hold_seconds=900)
    order = sorted(range(60), key=lambda i: (i // 12, i * 7 % 12))
    events = [position(i, vehicle=f"v{i % 3}") for i in order] + [position(3, timestamp="x")]
    size = -(-len(events) // pieces)
    for i in range(0, len(events), size):
        stream = send(GPS_TOPIC, *events[i : i + size], files_per_trigger=1)
    run(sinks.write_topic(stream, GPS_TOPIC, layout, "lake_gps", available_now=True))
    held = read_lake(spark, layout.lakes[0], "gps").count()
    assert held < len(events)
    records = spark.read.parquet(str(layout.work) + f"/topics/{GPS_TOPIC}")
    want = metrics(enrich_gps(clean(records)))
    for _ in range(2):
        sinks.drain_ordered(spark, layout)
        assert metrics(read_lake(spark, layout.lakes[0], "gps")) == want
    assert [r.n_late for r in ordered.late_positions(spark, layout).collect()] == [0]


def test_a_position_after_its_minute_is_stored_and_counted(spark, send, layout):
    def go(*seconds):
        stream = send(GPS_TOPIC, *[position(1, seconds=s) for s in seconds])
        run(sinks.write_ordered_lake(clean(stream), layout, delay_seconds=120, available_now=True))

    go(0, 60, 600)
    go(30, 540, 660)
    go(5000)
    sinks.drain_ordered(spark, layout)
    go(4000, 9000)
    sinks.drain_ordered(spark, layout)
    rows = {(r.event_time - START).total_seconds(): r.prev_event_time for r in read_lake(spark, layout.lakes[0], "gps").collect()}
    gone = {k: v and (v - START).total_seconds() for k, v in rows.items()}
    assert gone == {0: None, 30: None, 60: 0, 540: 60, 600: 540, 660: 600, 4000: None, 5000: 660, 9000: 5000}
    assert ordered.late_positions(spark, layout).first().n_late == 2


def test_a_replayed_ordered_batch_changes_nothing(spark, send, layout):
    send(GPS_TOPIC, *[position(i) for i in range(40)])
    rows = clean(spark.read.parquet(f"{layout.work}/topics/{GPS_TOPIC}"))
    write = sinks._enrich_in_order(layout, 120)
    for n in range(4):
        for _ in range(2):
            cut = F.expr(f"int(unix_seconds(event_time) / 40) % 4 = {n}")
            write(rows.filter(cut) if n < 3 else rows.filter(cut).limit(0), n)
    sinks.drain_ordered(spark, layout)
    assert read_lake(spark, layout.lakes[0], "gps").count() == 30
    write(rows.limit(0), 4)
    assert [f.name for f in Path(layout.state("held")).glob("writer=*/batch=*")] == ["batch=4"]


def test_state_of_first_arrivals_is_bounded(spark, send, layout):
    """Every record comes twice, a minute apart; keys leave the state an hour after they came."""
    for hour in range(5):
        for again in (0, 1):
            records = [step(f"p{hour}-{i}", "failed", hour * 60) for i in range(10)]
            stream = send(DELIVERY_TOPIC, *records, step("late", "failed", 0), files_per_trigger=1)
    hours = F.expr("make_interval(0, 0, 0, 0, int(offset / 22), int(offset / 11) % 2, 0)")
    stream = stream.withColumn("timestamp", F.col("timestamp") + hours)
    queries = sinks.write_first_arrivals(
        clean(stream, DELIVERY_TOPIC), "delivery", ["package_id", "event_time"], layout, "first", "30 minutes", True
    )
    run(queries)
    rows = read_lake(spark, layout.lakes[0], "delivery")
    assert rows.filter("package_id <> 'late'").count() == 50
    kept = [p["stateOperators"][0] for p in queries[0].recentProgress if p["stateOperators"]]
    assert max(k["numRowsTotal"] for k in kept) <= 22
    assert sum(k["numRowsDroppedByWatermark"] for k in kept) == 0


def test_state_of_a_new_checkpoint_wins(spark, send, tmp_path):
    layout = Layout([str(tmp_path / "lake")], str(tmp_path))
    for i in range(3):
        stream = send(GPS_TOPIC, position(i, vehicle="a"))
        run(sinks.write_vehicle_state(clean(stream), layout, available_now=True))
    send(GPS_TOPIC, position(9, vehicle="a"))
    run(sinks.write_vehicle_state(clean(stream), layout, query_name="anew", available_now=True))
    assert sinks.vehicle_states(layout).latest(spark).first().event_time == START + timedelta(seconds=360)


def test_watch_raises_what_a_query_raised(spark, send, layout):
    good = send(DELIVERY_TOPIC, step("p1", "failed", 0))
    running = sinks.write_lake(clean(good, DELIVERY_TOPIC), "delivery", layout, "running")

    def fail(batch, batch_id):
        raise ValueError("broken sink")

    bad = (
        good.writeStream.foreachBatch(fail)
        .option("checkpointLocation", layout.checkpoint("broken"))
        .queryName("broken")
        .start()
    )
    with pytest.raises(Exception, match="broken sink"):
        streams.watch(spark, 0.2, [*running, bad])
    assert not running[0].isActive
    assert {r.query_name: r.status for r in streams.progress(spark, [bad]).collect()} == {"broken": "failed"}


def test_rows_of_all_batches_are_counted(spark, send, layout):
    counter = streams.RowCounter()
    spark.streams.addListener(counter)
    try:
        for i in range(3):
            stream = send(DELIVERY_TOPIC, step(f"p{i}", "failed", 0), step(f"q{i}", "failed", 0))
            queries = sinks.write_lake(clean(stream, DELIVERY_TOPIC), "delivery", layout, "counted", True)
            run(queries)
            assert counter.of(queries[0]) == 2 * (i + 1)
    finally:
        spark.streams.removeListener(counter)


def test_every_batch_of_every_query_is_a_row(spark, send, layout):
    log = streams.ProgressLog(layout.state("progress"))
    spark.streams.addListener(log)
    try:
        for i in range(2):
            stream = send(DELIVERY_TOPIC, step(f"p{i}", "failed", 0), step(f"q{i}", "failed", 0))
            queries = sinks.write_lake(clean(stream, DELIVERY_TOPIC), "delivery", layout, "logged", True)
            first = sinks.write_first_arrivals(clean(stream, DELIVERY_TOPIC), "order", ["package_id"], layout, "firsts", available_now=True)
            run([*queries, *first])
            streams.watch(spark, 0, [*queries, *first], log)
    finally:
        spark.streams.removeListener(log)
    rows = streams.read_progress(spark, log.path).filter("n_input_rows > 0").collect()
    assert sorted((r.query_name, r.batch_id, r.n_input_rows) for r in rows if r.query_name == "logged") == [("logged", 0, 2), ("logged", 1, 2)]
    assert sum(r.n_input_rows for r in rows if r.query_name == "firsts") == 4
    assert max(r.n_state_rows for r in rows if r.query_name == "firsts") >= 2
    assert all(r.duration_ms > 0 for r in rows)


def test_a_slow_stream_does_not_hold_up_another(spark, send, layout):
    """Two streams in their own pools: the second ends while the first still has tasks waiting."""
    ended, pools = {}, []

    def slow(batch, batch_id):
        pools.append(batch.sparkSession.sparkContext.getLocalProperty("spark.scheduler.pool"))
        sleep = "java_method('java.lang.Thread', 'sleep', bigint(400))"
        batch.sparkSession.range(0, 160, 1, 160).selectExpr(f"{sleep} AS s").write.format("noop").mode("overwrite").save()
        ended["slow"] = time.time()

    def fast(batch, batch_id):
        batch.write.format("noop").mode("overwrite").save()
        ended["fast"] = time.time()

    stream = send(DELIVERY_TOPIC, step("p", "failed", 0))
    one = sinks._for_each_batch(stream, slow, layout, "slow", 1, True)
    time.sleep(1.5)
    two = sinks._for_each_batch(stream, fast, layout, "fast", 1, True)
    run([two, one])
    assert ended["fast"] < ended["slow"] and pools == ["slow"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_progress_and_stop(spark, send, layout):
    stream = send(DELIVERY_TOPIC, step("p1", "failed", 0))
    queries = sinks.write_lake(clean(stream, DELIVERY_TOPIC), "delivery", layout, "watched")
    queries[0].processAllAvailable()
    rows = {r.query_name: r for r in streams.progress(spark).collect()}
    assert "watched" in rows and rows["watched"].status
    streams.stop_all(spark)
    assert not queries[0].isActive


# --- load and batch job ------------------------------------------------------


def lake_rows(spark, lake, event_type, *rows):
    schema = {
        "order": "order_id string, package_id string, status string, event_time timestamp, extra int",
        "driver": "DRIVER_ID string, status string, event_time timestamp",
    }[event_type]
    (
        spark.createDataFrame(list(rows), schema)
        .coalesce(1)
        .write.mode("append")
        .parquet(lake_path(lake, event_type) + f"/event_date=2026-01-01/event_type={event_type}")
    )


def test_incremental_load(spark, tmp_path):
    lake, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    lake_rows(spark, lake, "order", ("o1", "p1", "created", START, 7))
    lake_rows(spark, lake, "driver", ("d1", "online", START))

    def summary(**options):
        return {r.table_name: r for r in load_events(spark, lake, raw, **options).collect()}

    first = summary()
    assert (first["orders"].n_files, first["orders"].n_loaded, first["orders"].n_rows_after) == (1, 1, 1)
    assert (first["gps_events"].n_files, first["gps_events"].n_rows_after) == (0, 0)
    driver = read_raw(spark, raw, "driver_events").first()
    assert driver.driver_id == "d1" and driver.vehicle_id is None and driver.load_timestamp is not None

    assert summary()["orders"].n_loaded == 0
    lake_rows(spark, lake, "order", ("o2", "p2", "created", START, 8), ("o3", "p3", "created", START, 9))
    folder = tmp_path / "lake/events/order/event_date=2026-01-01/event_type=order"
    (folder / "broken.parquet").write_text("no parquet")
    (folder / "notes.txt").write_text("ignored")
    third = summary(event_type="order")
    assert list(third) == ["orders"]
    assert (third["orders"].n_files, third["orders"].n_loaded, third["orders"].n_rows_after) == (1, 2, 3)
    assert third["orders"].n_errors == 1
    assert read_load_audit(spark, raw).count() == 3

    again = summary(event_type="order", truncate=True)
    assert (again["orders"].n_loaded, again["orders"].n_rows_after) == (3, 3)
    assert read_raw(spark, raw, "orders").count() == 3
    assert read_raw(spark, raw, "driver_events").count() == 1


def test_old_and_empty_files(spark, tmp_path):
    lake, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    lake_rows(spark, lake, "order", ("o1", "p1", "created", START, 7))
    for file in (tmp_path / "lake").rglob("*.parquet"):
        os.utime(file, (1, 1))
    lake_rows(spark, lake, "order", ("o2", "p2", "created", START, 7))
    lake_rows(spark, lake, "order")
    row = load_events(spark, lake, raw, "order").first()
    assert (row.n_files, row.n_loaded, row.n_empty, row.n_errors) == (2, 2, 1, 0)


def test_a_load_opens_only_what_gave_no_row_and_only_once(spark, tmp_path):
    """Files that gave rows are never opened again, whatever their size; outcomes are kept by file."""
    lake, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    lake_rows(spark, lake, "order", *[(f"o{i}", f"p{i}", "created", START, i) for i in range(500)])
    folder = tmp_path / "lake/events/order/event_date=2026-01-01/event_type=order"
    (good,) = folder.glob("*.parquet")
    load_events(spark, lake, raw, "order").collect()
    (folder / "broken.parquet").write_text("no parquet")
    (folder / "cut.parquet").write_bytes(good.read_bytes()[:-9])
    opened = []
    look = load._rows_inside

    def watched(session, paths):
        opened.append(len(paths))
        return look(session, paths)

    load._rows_inside = watched
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", good.stat().st_size - 1)
    try:
        rows = [load_events(spark, lake, raw, "order").first() for _ in range(2)]
    finally:
        load._rows_inside = look
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert [(r.n_files, r.n_loaded, r.n_empty, r.n_errors) for r in rows] == [(0, 0, 0, 2)] * 2
    assert opened == [2]
    assert load._rows_by_footer(spark, str(good)) == 500
    assert load._rows_by_footer(spark, str(folder / "cut.parquet")) is None


def test_a_file_that_came_too_late_for_the_load_waits(spark, tmp_path):
    lake, raw = str(tmp_path / "lake"), str(tmp_path / "raw")
    lake_rows(spark, lake, "order", ("o1", "p1", "created", START, 7))
    load._look_into_rowless(spark, lake, raw, ["order"], 0)
    assert load.read_load_outcomes(spark, raw).count() == 0
    row = load_events(spark, lake, raw, "order").first()
    assert (row.n_files, row.n_loaded, row.n_empty, row.n_errors) == (1, 1, 0, 0)


def test_reload_of_an_empty_lake_empties_raw(spark, tmp_path):
    raw = str(tmp_path / "raw")
    lake_rows(spark, str(tmp_path / "lake"), "order", ("o1", "p1", "created", START, 7))
    load_events(spark, str(tmp_path / "lake"), raw, "order").collect()
    row = load_events(spark, str(tmp_path / "nothing"), raw, "order", truncate=True).first()
    assert (row.n_files, row.n_loaded, row.n_rows_after) == (0, 0, 0)
    assert read_raw(spark, raw, "orders").count() == 0
    row = load_events(spark, str(tmp_path / "lake"), raw, "order", truncate=True).first()
    assert (row.n_loaded, row.n_rows_after) == (1, 1)


def test_file_inventory(spark, tmp_path):
    lake = str(tmp_path / "lake")
    assert {r.event_type: r.n_files for r in file_inventory(spark, lake).collect()} == {
        "gps": 0, "delivery": 0, "order": 0, "driver": 0,
    }
    lake_rows(spark, lake, "order", ("o1", "p1", "created", START, 7))
    rows = {r.event_type: r for r in file_inventory(spark, lake).collect()}
    assert rows["order"].n_files == 1 and rows["order"].n_bytes > 0 and rows["gps"].n_bytes == 0
    assert [r.event_type for r in file_inventory(spark, lake, "order").collect()] == ["order"]


def test_reading_a_lake_that_is_not_there(spark, tmp_path):
    rows = read_lake(spark, str(tmp_path / "nothing"), "gps")
    assert rows.count() == 0 and "anomaly_types" in rows.columns


def raw_tables(spark, order_id="o1"):
    t = START
    return {
        "gps_events": spark.createDataFrame(
            [("v", "d", 45.5, -73.6, 10.0, t, t)],
            "vehicle_id string, driver_id string, lat double, lon double, speed_kmh double, event_time timestamp, load_timestamp timestamp",
        ),
        "delivery_events": spark.createDataFrame(
            [("p", "o1", "v", None, "delivered", t, t)],
            "package_id string, order_id string, vehicle_id string, driver_id string, status string, event_time timestamp, load_timestamp timestamp",
        ),
        "orders": spark.createDataFrame(
            [(order_id, "p", "created", t, t)],
            "order_id string, package_id string, status string, event_time timestamp, load_timestamp timestamp",
        ),
        "driver_events": spark.createDataFrame(
            [("d", "v", "online", t, t)],
            "driver_id string, vehicle_id string, status string, event_time timestamp, load_timestamp timestamp",
        ),
    }


@pytest.mark.parametrize("stored", [True, False])
def test_batch_job(spark, tmp_path, stored):
    tables = jobs.run_batch(spark, raw_tables(spark), str(tmp_path), stored_staging=stored)
    row = tables["fct_deliveries"].first()
    assert (row.driver_id, row.final_status, row.minutes_order_to_delivery) == ("d", "delivered", 0)
    assert row.mart_refreshed_at is not None
    assert tables["dim_date"].count() == 61 and "days_from_today" in tables["dim_date"].columns
    assert spark.table("fleet.dim_drivers").count() == 1
    assert spark.table("fleet.stg_orders" if stored else "stg_orders").count() == 1


def test_batch_job_stops_at_a_failed_gate(spark, tmp_path):
    with pytest.raises(jobs.GateFailed) as error:
        jobs.run_batch(spark, raw_tables(spark, order_id=None), str(tmp_path))
    assert error.value.stage == "raw"
    assert error.value.failures == [("orders", "not_null", "order_id", 1)]
    assert not list(tmp_path.glob("run-*/marts"))


def test_a_failed_gate_leaves_the_published_tables(spark, tmp_path):
    jobs.run_batch(spark, raw_tables(spark), str(tmp_path), schema="gated")
    with pytest.raises(jobs.GateFailed):
        jobs.run_batch(spark, raw_tables(spark, order_id=None), str(tmp_path), schema="gated")
    assert spark.table("gated.fct_deliveries").count() == 1
    names = {r.tableName for r in spark.sql("SHOW TABLES IN gated").collect() if not r.isTemporary}
    assert len(names) == 9


def test_from_lake_to_marts(spark, send, tmp_path):
    lake = str(tmp_path / "lake")
    layout = Layout([lake], str(tmp_path))
    stamp = {"timestamp": START.isoformat() + "+00:00"}
    sources = {
        GPS_TOPIC: send(GPS_TOPIC, position(0), position(1)),
        DELIVERY_TOPIC: send(DELIVERY_TOPIC, step("p", "delivered", 30)),
        ORDER_TOPIC: send(ORDER_TOPIC, {"order_id": "o", "package_id": "p", "status": "created", **stamp}),
        "driver_events": send("driver_events", {"driver_id": "d", "vehicle_id": "v", "status": "online", **stamp}),
    }
    run(streams.start_topics(sources, layout, available_now=True))
    tables = jobs.run_pipeline(spark, lake, str(tmp_path / "raw"), str(tmp_path / "out"))
    row = tables["fct_deliveries"].first()
    assert (row.driver_id, row.minutes_order_to_delivery) == ("d", 30)
    assert tables["fct_daily_activity"].first().n_gps_points == 2


def test_work_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(shared) and first != second


def test_layout_gives_every_query_and_target_a_checkpoint():
    layout = Layout(["/a/", "/b"], "/w")
    assert layout.events("gps") == ["/a/events/gps", "/b/events/gps"]
    assert layout.checkpoint("q") == "/w/checkpoints/q" and layout.checkpoint("q", 1) == "/w/checkpoints/q_1"
