"""Streaming sinks. Each ``write_...`` starts one named query with its own checkpoint."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from convoy.plans.ingest import split_valid_invalid, clean_events, with_lake_columns, with_reject_date
from convoy.plans.state import STATE_FIELDS, live_state, merge_state, vehicle_state
from convoy.schemas import (
    EVENT_TYPE_BY_TOPIC,
    GPS_TOPIC,
    STATE_TTL_SECONDS,
    struct_of,
)
from convoy.session import pool
from convoy.sources.lake import file_exists, write_file
from convoy.sources.manifest import read_stored
from convoy.sources.topics import parse_events
from convoy.streaming import ordered
from convoy.streaming.enrich import advance, enrich_batch, last_positions
from convoy.streaming.layout import Layout
from convoy.streaming.state import KeyedState

LAKE_PARTITIONS = ["event_date", "event_type"]
DEAD_LETTER_PARTITIONS = ["reject_date", "reject_topic"]

VEHICLE_STATE = struct_of(
    "vehicle_id string, driver_id string, lat double, lon double, speed_kmh double, "
    "event_time timestamp, updated_at timestamp"
)


def _triggered(writer: DataStreamWriter, seconds: int, available_now: bool) -> DataStreamWriter:
    """Every few seconds, or once over everything that is there."""
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def _writer(batch: DataFrame) -> str:
    """Id of the streaming query that handles this batch: kept in its checkpoint, so it stays through
    restarts, and a new checkpoint, whose batches count from 0 again, has another one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def _append_batch(
    rows: DataFrame, path: str, partitions: list[str], batch_id: int, writer: str | None = None
) -> None:
    """Add a batch to a partitioned table; replaying it replaces its own files only."""
    (
        rows.withColumns({"writer_id": F.lit(writer or _writer(rows)), "batch_id": F.lit(batch_id)})
        .write.partitionBy(*partitions, "writer_id", "batch_id")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def _append_to_all(
    rows: DataFrame,
    paths: list[str],
    partitions: list[str],
    batch_id: int,
    writer: str | None = None,
    commits: str | None = None,
) -> None:
    """Write to every target, computing the rows once.

    A batch for several targets is committed as one, by a small record in ``commits`` after the last
    target: replayed before it, a batch is written to all of them anew; after it, to none.
    """
    if len(paths) == 1:
        return _append_batch(rows, paths[0], partitions, batch_id, writer)
    record = f"{commits}/writer={writer or _writer(rows)}/batch={batch_id}" if commits else None
    if record and file_exists(rows.sparkSession, record):
        return None
    rows = rows.persist()
    try:
        for path in paths:
            _append_batch(rows, path, partitions, batch_id, writer)
    finally:
        rows.unpersist()
    if record:
        write_file(rows.sparkSession, record, "\n".join(paths).encode())


def _for_each_batch(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    layout: Layout,
    query_name: str,
    seconds: int,
    available_now: bool,
) -> StreamingQuery:
    writer = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", layout.checkpoint(query_name))
        .queryName(query_name)
    )
    with pool(stream.sparkSession, query_name):
        return _triggered(writer, seconds, available_now).start()


def write_lake(
    events: DataFrame, event_type: str, layout: Layout, query_name: str, available_now: bool = False
) -> list[StreamingQuery]:
    """Clean events to the lake as they are, by Spark's own Parquet sink, one query per target."""
    prepared = with_lake_columns(events, event_type)
    queries = []
    for target, path in enumerate(layout.events(event_type)):
        name = query_name if target == 0 else f"{query_name}_{target}"
        writer = (
            prepared.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", layout.checkpoint(query_name, target))
            .partitionBy(*LAKE_PARTITIONS)
            .outputMode("append")
            .queryName(name)
        )
        with pool(events.sparkSession, name):
            queries.append(_triggered(writer, layout.trigger_seconds, available_now).start())
    return queries


def write_dead_letters(
    rejected: DataFrame, layout: Layout, query_name: str, available_now: bool = False
) -> StreamingQuery:
    """Rejected events, as they came, by day of arrival and topic: a batch that is replayed on the next day
    is filed where it was."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The topics share one table; the topic in the partition keeps their batches apart.
        rows = with_reject_date(batch, F.to_date("kafka_timestamp"))
        _append_to_all(
            rows, layout.dead_letters(), DEAD_LETTER_PARTITIONS, batch_id, commits=layout.commits("dead_letters")
        )

    return _for_each_batch(
        rejected, write_batch, layout, query_name, layout.trigger_seconds, available_now
    )


def _enrich_and_store(layout: Layout, carry: bool) -> Callable[[DataFrame, int], None]:
    state = last_positions(layout.state("last_positions"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        last = state.before(batch.sparkSession, batch_id) if carry else None
        rows = with_lake_columns(enrich_batch(batch, last), EVENT_TYPE_BY_TOPIC[GPS_TOPIC])
        _append_to_all(rows, layout.events("gps"), LAKE_PARTITIONS, batch_id, commits=layout.commits("events"))
        if carry:
            state.write(advance(last, batch), batch_id)

    return write_batch


def write_enriched_lake(
    positions: DataFrame,
    layout: Layout,
    query_name: str = "lake_gps",
    carry: bool = True,
    available_now: bool = False,
) -> StreamingQuery:
    """Positions with movement metrics and anomalies to the lake.

    ``carry=False`` starts every micro-batch without a past, so results depend on where
    batches are cut; ``carry=True`` gives what one pass over the ordered history gives.
    """
    return _for_each_batch(
        positions,
        _enrich_and_store(layout, carry),
        layout,
        query_name,
        layout.trigger_seconds,
        available_now,
    )


def _enrich_in_order(layout: Layout, delay_seconds: int) -> Callable[[DataFrame, int], None]:
    def write(rows: DataFrame, batch_id: int) -> None:
        _append_to_all(rows, layout.events("gps"), LAKE_PARTITIONS, batch_id, commits=layout.commits("events"))

    return ordered.hold_and_release(layout, delay_seconds, write, _writer)


def write_ordered_lake(
    positions: DataFrame,
    layout: Layout,
    query_name: str = "lake_gps",
    delay_seconds: int = 600,
    available_now: bool = False,
) -> StreamingQuery:
    """Positions with movement metrics and anomalies to the lake, exact for all that arrive within the delay.

    A position may arrive ``delay_seconds`` after the newest one seen and still gets its true predecessor, and is
    the predecessor of those that follow it. The lake lags behind by the delay and a minute; ``drain_ordered``
    ends that when a stream has ended. ``ordered.late_positions`` counts those that came later.
    """
    return _for_each_batch(
        positions,
        _enrich_in_order(layout, delay_seconds),
        layout,
        query_name,
        layout.trigger_seconds,
        available_now,
    )


def drain_ordered(spark: SparkSession, layout: Layout) -> None:
    """Enrich and store what the ordered streams of a layout still hold; no such stream may run."""

    def write(rows: DataFrame, writer: str, batch_id: int) -> None:
        events = layout.events("gps")
        _append_to_all(rows, events, LAKE_PARTITIONS, batch_id, writer, layout.commits("events"))

    ordered.drain(spark, layout, write)


class VehicleStates(KeyedState):
    """The vehicles as readers see them: those heard of within the time-to-live before ``as_of`` (now)."""

    def __init__(self, path: str, ttl_seconds: int = STATE_TTL_SECONDS, fold_every: int = 100):
        self.ttl_seconds = ttl_seconds
        super().__init__(path, VEHICLE_STATE, merge_state, self.live, fold_every)

    def live(self, rows: DataFrame, as_of: Column | None = None) -> DataFrame:
        return live_state(rows, F.current_timestamp() if as_of is None else as_of, self.ttl_seconds)

    def latest(self, spark: SparkSession, as_of: Column | None = None) -> DataFrame:
        return self.live(super().latest(spark), as_of)


def vehicle_states(layout: Layout, ttl_seconds: int = STATE_TTL_SECONDS) -> VehicleStates:
    return VehicleStates(layout.state("vehicles"), ttl_seconds)


def _update_vehicles(layout: Layout, ttl_seconds: int) -> Callable[[DataFrame, int], None]:
    state = vehicle_states(layout, ttl_seconds)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        fresh = vehicle_state(batch.select("vehicle_id", *STATE_FIELDS), updated_at=F.current_timestamp())
        state.write(fresh, batch_id, _writer(batch))

    return write_batch


def write_vehicle_state(
    positions: DataFrame,
    layout: Layout,
    query_name: str = "gps_state",
    ttl_seconds: int = STATE_TTL_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep the latest position per vehicle; vehicles silent for the time-to-live drop out.

    A batch writes the vehicles it has heard of and no others, see ``KeyedState``.
    """
    return _for_each_batch(
        positions,
        _update_vehicles(layout, ttl_seconds),
        layout,
        query_name,
        layout.state_trigger_seconds,
        available_now,
    )


def write_once(
    events: DataFrame,
    event_type: str,
    keys: list[str],
    layout: Layout,
    query_name: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Clean events to the lake, each only the first time it comes.

    Events with a time are told apart by ``keys`` (with ``event_time``); of several in one batch that differ
    otherwise the least row stays. Events without a time are told apart by all of their columns, the
    time of arrival included. However late, an event is compared with what the lake has of its own day, so nothing
    is forgotten and nothing but repeats is dropped.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = with_lake_columns(batch, event_type)
        columns = [c for c in batch.columns if c not in keys]
        rest = F.min(F.struct(*columns)).alias("rest")
        timed = rows.filter("event_time is not null").groupBy(*keys, "event_type", "event_date").agg(rest)
        timed = timed.select(*keys, *[f"rest.{c}" for c in columns], "event_type", "event_date")
        untimed = rows.filter("event_time is null").distinct()
        for root, path in zip(layout.lakes, layout.events(event_type)):
            stored = read_stored(batch.sparkSession, root, event_type)
            own = F.col("writer_id").eqNullSafe(_writer(batch)) & F.col("batch_id").eqNullSafe(batch_id)
            known = stored.filter(~own).drop("writer_id", "batch_id")
            days = timed.select("event_date").distinct()
            seen = known.join(days, "event_date", "left_semi").select("event_date", *keys).alias("s")
            known_by = [F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ["event_date", *keys]]
            new = timed.alias("t").join(seen, known_by, "left_anti").select(rows.columns)
            same = [c for c in batch.columns if c != "event_time"]
            there = known.filter("event_date is null").select(*same).alias("k")
            equal = [F.col(f"u.{c}").eqNullSafe(F.col(f"k.{c}")) for c in same]
            also = untimed.alias("u").join(there, equal, "left_anti").select(rows.columns)
            _append_batch(new.unionByName(also), path, LAKE_PARTITIONS, batch_id)

    return _for_each_batch(
        events, write_batch, layout, query_name, layout.trigger_seconds, available_now
    )


def first_arrivals(events: DataFrame, keys: list[str], within: str) -> DataFrame:
    """Events that did not come before within the given time of arrival, told apart by ``keys``.

    The watermark follows the time of arrival (``kafka_timestamp``), not that of the event: what is repeated,
    is repeated soon, and an event that happened long ago is no repeat. The state holds the keys that arrived in
    that time and no others. Events without a time are told apart by all columns but the time of arrival. A record that stands further
    back than ``within`` in a topic partition that lags behind the others is dropped; the progress of the query
    counts such rows (numRowsDroppedByWatermark), so choose ``within`` above the lag between partitions.
    """
    whole = F.sha2(F.to_json(F.struct(*[c for c in events.columns if c not in ("event_time", "kafka_timestamp")])), 256)
    untimed = F.when(F.col("event_time").isNull(), whole).otherwise(F.lit(""))
    marked = events.withColumn("_untimed", untimed).withWatermark("kafka_timestamp", within)
    return marked.dropDuplicatesWithinWatermark([*keys, "_untimed"]).drop("_untimed")


def write_first_arrivals(
    events: DataFrame,
    event_type: str,
    keys: list[str],
    layout: Layout,
    query_name: str,
    within: str = "1 hour",
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Clean events to the lake without the repeats of the last while: bounded state, nothing of the lake is read.

    ``write_once`` compares with all days of the lake instead, for repeats of any age.
    """
    return write_lake(first_arrivals(events, keys, within), event_type, layout, query_name, available_now)


def write_topic(
    records: DataFrame, topic: str, layout: Layout, query_name: str, available_now: bool = False
) -> StreamingQuery:
    """Everything that is made of one topic, in one query that reads the topic once:
    lake rows (enriched for positions), dead letters and, for positions, the vehicle state."""
    is_gps = topic == GPS_TOPIC
    event_type = EVENT_TYPE_BY_TOPIC[topic]
    if layout.hold_seconds is None:
        enrich = _enrich_and_store(layout, carry=True)
    else:
        enrich = _enrich_in_order(layout, layout.hold_seconds)
    update_vehicles = _update_vehicles(layout, STATE_TTL_SECONDS)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch, topic).persist()
        try:
            valid, rejected = split_valid_invalid(parsed, topic)
            clean = clean_events(valid)
            if is_gps:
                enrich(clean, batch_id)
                update_vehicles(clean, batch_id)
            else:
                rows = with_lake_columns(clean, event_type)
                events = layout.events(event_type)
                _append_to_all(rows, events, LAKE_PARTITIONS, batch_id, commits=layout.commits("events"))
            _append_to_all(
                with_reject_date(rejected, F.to_date("kafka_timestamp")),
                layout.dead_letters(),
                DEAD_LETTER_PARTITIONS,
                batch_id,
                commits=layout.commits("dead_letters"),
            )
        finally:
            parsed.unpersist()

    return _for_each_batch(
        records, write_batch, layout, query_name, layout.trigger_seconds, available_now
    )
