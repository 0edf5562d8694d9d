"""Positions of a stream in the exact order of their times, whatever the order in which they arrive.

A position is held until the watermark has passed its minute: the greatest time seen, less the delay. Then all
positions of that minute that are on time are there, so minutes leave complete and one after the other, and every
batch finds its vehicles' predecessors among the last positions of the minutes before. Where batches are cut does not
matter. Positions that come after their minute has left go to the lake at once, without metrics, and are
counted; positions without a time do the same.

A batch writes its positions once, into a folder of its own, and reads the minutes that leave from the folders that
still have some; Parquet's own statistics skip the rest of them. A folder is removed once all of it has left. So
what is stored is bounded by the delay. A minute of a busy vehicle is spread over the tasks like any other rows.
"""

import json

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.plans.enrich import add_anomaly_flags, with_movement
from convoy.plans.ingest import with_lake_columns
from convoy.schemas import EVENT_TYPE_BY_TOPIC, GPS_TOPIC, struct_of
from convoy.session import work_folder
from convoy.sources.lake import folder_values, remove_folder
from convoy.streaming.enrich import LAST_POSITION, advance, enrich_batch
from convoy.streaming.layout import Layout
from convoy.streaming.state import BatchState, KeyedState

#: Minutes since 1970 from ``held_from`` on are held; all before have left. Late rows are counted over all batches.
#: ``holding``: the last minute of every batch's folder that still holds some, as JSON.
PROGRESS = struct_of("batch_id bigint, held_from bigint, seen_micros bigint, n_late bigint, holding string")
#: The minute of positions that are not held.
AT_ONCE = -(2**40)
#: Greater than the minute of any timestamp.
ALL_MINUTES = 2**40
_MINUTE = 60_000_000


def newest_position(rows: DataFrame) -> DataFrame:
    """One row per vehicle. Of equal times the later batch's."""
    newest = F.max(F.struct("event_time", "state_batch", "lat", "lon")).alias("newest")
    return rows.groupBy("vehicle_id").agg(newest).select("vehicle_id", "newest.*")


def last_positions(layout: Layout) -> KeyedState:
    return KeyedState(layout.state("ordered_positions"), LAST_POSITION, newest_position)


def _progress(layout: Layout, writer: str) -> BatchState:
    return BatchState(f"{layout.state('ordered_progress')}/writer={writer}", PROGRESS)


def _held_path(layout: Layout, writer: str) -> str:
    return f"{layout.state('held')}/writer={writer}"


def without_predecessor(positions: DataFrame) -> DataFrame:
    """The columns of enriched positions for rows whose place in the order is gone."""
    none = {f"prev_{c}": F.lit(None).cast(t) for c, t in (("lat", "double"), ("lon", "double"), ("event_time", "timestamp"))}
    return positions.withColumns(none).transform(with_movement).transform(add_anomaly_flags)


def hold_and_release(
    layout: Layout, delay_seconds: int, write: Callable[[DataFrame, int], None], writer_of: Callable[[DataFrame], str]
) -> Callable[[DataFrame, int], None]:
    """Handler of micro-batches. ``write`` gets the lake rows of a batch and its number."""
    state = last_positions(layout)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark, writer = batch.sparkSession, writer_of(batch)
        progress, held = _progress(layout, writer), _held_path(layout, writer)
        before = progress.before(spark, batch_id).first()
        held_from, seen, n_late, holding = before[1:] if before else (AT_ONCE + 1, None, 0, "{}")
        holding = json.loads(holding)
        for number in folder_values(spark, held, "batch"):
            if number not in holding and int(number) < batch_id:
                remove_folder(spark, f"{held}/batch={number}")

        own = F.floor(F.unix_micros("event_time") / _MINUTE).cast("long")
        rows = batch.withColumn("minute", F.when(own >= held_from, own).otherwise(F.lit(AT_ONCE)))
        rows.write.mode("overwrite").parquet(f"{held}/batch={batch_id}")
        mine = spark.read.schema(rows.schema).parquet(f"{held}/batch={batch_id}")
        late = F.count_if((F.col("minute") == AT_ONCE) & F.col("event_time").isNotNull())
        newest = F.max(F.unix_micros("event_time"))
        found = mine.agg(newest.alias("seen"), late.alias("n_late"), F.max("minute").alias("last")).first()
        seen = max((t for t in (seen, found.seen) if t is not None), default=None)
        leave_from = held_from if seen is None else max(held_from, (seen - delay_seconds * 1_000_000) // _MINUTE)
        holding[str(batch_id)] = AT_ONCE if found["last"] is None else found["last"]

        released = _release(spark, held, holding, held_from, leave_from, rows)
        at_once = mine.filter(F.col("minute") == AT_ONCE).drop("minute").transform(without_predecessor)
        last = state.before(spark, batch_id, writer)
        enriched = enrich_batch(released, last)
        both = enriched.unionByName(at_once.select(enriched.columns))
        write(with_lake_columns(both, EVENT_TYPE_BY_TOPIC[GPS_TOPIC]), batch_id)
        state.write(_moved(last, released), batch_id, writer)
        still = json.dumps({number: end for number, end in holding.items() if end >= leave_from})
        row = (batch_id, leave_from, seen, n_late + found.n_late, still)
        progress.write(spark.createDataFrame([row], PROGRESS), batch_id)

    return write_batch


def _release(
    spark: SparkSession, held: str, holding: dict[str, int], first: int, until: int, rows: DataFrame | None = None
) -> DataFrame:
    """Positions of the minutes from ``first`` to before ``until``; ``rows`` has the columns of those held."""
    paths = [f"{held}/batch={number}" for number, end in holding.items() if end >= first]
    if not paths:
        return rows.limit(0).drop("minute")
    schema = spark.read.parquet(paths[0]).schema if rows is None else rows.schema
    due = (F.col("minute") >= first) & (F.col("minute") < until)
    return spark.read.schema(schema).parquet(*paths).filter(due).drop("minute")


def _moved(last: DataFrame, released: DataFrame) -> DataFrame:
    """Newest position of the vehicles that have moved on, and of no others."""
    return advance(last.limit(0), released)


def drain(
    spark: SparkSession, layout: Layout, write: Callable[[DataFrame, str, int], None]
) -> None:
    """Let everything go that is held, in order, after the streams have ended: what comes later is late.

    ``write`` gets the lake rows, a writer's name and a batch number. A drained stream may be started again; a call
    that broke off is repeated as a whole.
    """
    for writer in folder_values(spark, layout.state("ordered_progress"), "writer"):
        progress, held = _progress(layout, writer), _held_path(layout, writer)
        at = progress.latest(spark).first()
        if at is None or at.holding == "{}":
            continue
        released = _release(spark, held, json.loads(at.holding), at.held_from, ALL_MINUTES)
        state = last_positions(layout)
        last = state.before(spark, at.batch_id + 1, writer)
        rows = with_lake_columns(enrich_batch(released, last), EVENT_TYPE_BY_TOPIC[GPS_TOPIC])
        write(rows, f"{writer}-drained", at.batch_id)
        newest = released.agg(F.max(F.unix_micros("event_time"))).first()[0]
        # from now on the newest batch has moved the drained vehicles too
        scratch = work_folder(spark, "drained")
        last.unionByName(_moved(last, released)).withColumn("state_batch", F.lit(at.batch_id)).transform(
            newest_position
        ).write.parquet(scratch)
        state.write(spark.read.parquet(scratch), at.batch_id, writer)
        row = (at.batch_id, max(at.held_from, newest // _MINUTE + 1), max(at.seen_micros, newest), at.n_late, "{}")
        progress.write(spark.createDataFrame([row], PROGRESS), at.batch_id)


def late_positions(spark: SparkSession, layout: Layout) -> DataFrame:
    """Per writer the positions that came after their minute had left."""
    rows = []
    for writer in folder_values(spark, layout.state("ordered_progress"), "writer"):
        at = _progress(layout, writer).latest(spark).first()
        rows += [(writer, at.n_late)] if at else []
    return spark.createDataFrame(rows, "writer_id string, n_late bigint")
