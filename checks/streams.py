"""Queries that run through files and streams: topics in, lake, dead letters, state, RAW tables.

Records derived from ``events`` arrive in three pieces, in the order of time. After each
piece the streaming query is started again from its checkpoint and works off what is new.
"""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from checks.fleet import raw_tables, topic_records
from convoy.plans import ingest, jobs
from convoy.plans.enrich import enrich_gps
from convoy.plans.refresh import read_fact, refresh_facts
from convoy.schemas import DELIVERY_TOPIC, DRIVER_TOPIC, EVENT_TYPE_BY_TOPIC, GPS_TOPIC, ORDER_TOPIC, RAW_SCHEMAS
from convoy.session import work_folder
from convoy.sources import manifest
from convoy.sources.lake import dead_letter_path, file_exists, file_inventory, lake_path, publish_folder, write_file
from convoy.sources.load import load_events, read_raw
from convoy.sources.manifest import read_lake
from convoy.sources.topics import read_topic_files
from convoy.streaming import jobs as streams
from convoy.streaming import sinks
from convoy.streaming.enrich import mend_lake
from convoy.streaming.layout import Layout

LOAD_SUMMARY = "table_name string, n_files long, n_loaded long, n_empty long, n_errors long, n_rows_after long"
TOPICS = [GPS_TOPIC, DELIVERY_TOPIC, ORDER_TOPIC, DRIVER_TOPIC]
#: What makes a delivery step: a package can take several at one instant.
STEP = ["package_id", "event_time", "status"]


def piece(rows: DataFrame, time: str, n: int = 3) -> Column:
    """The piece of a row if a table is cut at equal steps between its first and its last time; rows without a time
    are in the first."""
    first, last = rows.agg(F.min(time), F.max(time)).first()
    if first is None:
        return F.lit(0)
    step = (last - first) / n
    bounds = [first + i * step for i in range(1, n)]
    return F.coalesce(sum((F.col(time) >= F.lit(b)).cast("int") for b in bounds), F.lit(0))


def pieces(rows: DataFrame, time: str, n: int = 3) -> list[DataFrame]:
    """Consecutive pieces of a table."""
    index = piece(rows, time, n)
    return [rows.filter(index == i) for i in range(n)]


def held(rows: DataFrame, folder: str) -> DataFrame:
    """Rows that are cut into pieces, computed once."""
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def arrive(
    spark: SparkSession,
    folder: str,
    records: dict[str, DataFrame],
    start: Callable[[dict[str, DataFrame]], list[StreamingQuery]],
    order: tuple[int, ...] = (0, 1, 2),
    by: str = "timestamp",
) -> list[StreamingQuery]:
    """Let the records arrive piece by piece and run the queries over each; all runs' queries."""
    cut = {topic: pieces(rows, by) for topic, rows in records.items()}
    ran = []
    for i in order:
        for topic, parts in cut.items():
            parts[i].write.mode("append").parquet(f"{folder}/topics/{topic}")
        sources = {t: read_topic_files(spark, f"{folder}/topics/{t}") for t in records}
        queries = start(sources)
        for q in queries:
            q.awaitTermination()
        ran += queries
    return ran


def _one(spark, sf_dir, purpose, topic, start):
    """Folder and layout after one topic went through ``start(clean, rejected, layout)``."""
    folder = work_folder(spark, purpose)
    layout = Layout([f"{folder}/lake"], folder)

    def go(sources):
        return start(*ingest.topic_pipeline(sources[topic], topic), layout)

    arrive(spark, folder, {topic: topic_records(spark, sf_dir, topic)}, go)
    return layout


def stream_enriched(spark, sf_dir):
    """Positions through the enriching sink: equals one pass over the ordered history."""

    def start(clean, _, layout):
        return [sinks.write_enriched_lake(clean, layout, available_now=True)]

    layout = _one(spark, sf_dir, "enriched", GPS_TOPIC, start)
    return read_lake(spark, layout.lakes[0], "gps")


def stream_late(spark, sf_dir):
    """Positions whose middle piece arrives last, after the days it touches were enriched anew: equals one
    pass over the ordered history."""
    folder = work_folder(spark, "late")
    layout = Layout([f"{folder}/lake"], folder)
    records = topic_records(spark, sf_dir, GPS_TOPIC)

    def start(sources):
        clean = ingest.topic_pipeline(sources[GPS_TOPIC], GPS_TOPIC)[0]
        return [sinks.write_enriched_lake(clean, layout, available_now=True)]

    arrive(spark, folder, {GPS_TOPIC: records}, start, order=(0, 2, 1))
    late = pieces(records, "timestamp")[1].agg(F.to_date(F.min("timestamp"))).first()[0]
    mend_lake(spark, layout.lakes[0], late)
    return read_lake(spark, layout.lakes[0], "gps")


def stream_ordered(spark, sf_dir):
    """Positions that arrive out of order, up to six hours late, held for that time and drained at the end: equals
    one pass over the ordered history, without any later correction."""
    folder = work_folder(spark, "ordered")
    layout = Layout([f"{folder}/lake"], folder, hold_seconds=6 * 3600)
    late = F.make_dt_interval(secs=F.pmod(F.xxhash64("value"), F.lit(6 * 3600)).cast("double"))
    records = topic_records(spark, sf_dir, GPS_TOPIC).withColumn("arrival", F.col("timestamp") + late)
    records = held(records, f"{folder}/sent")

    def start(sources):
        return [sinks.write_topic(sources[GPS_TOPIC], GPS_TOPIC, layout, "lake_gps", True)]

    arrive(spark, folder, {GPS_TOPIC: records}, start, by="arrival")
    sinks.drain_ordered(spark, layout)
    return read_lake(spark, layout.lakes[0], "gps")


def stream_first_arrivals(spark, sf_dir):
    """Every record arrives again ten minutes later; each delivery step comes out once, from a state that holds
    an hour of arrivals."""
    folder = work_folder(spark, "first")
    layout = Layout([f"{folder}/lake"], folder)
    once = topic_records(spark, sf_dir, DELIVERY_TOPIC)
    again = once.withColumn("timestamp", F.col("timestamp") + F.expr("interval 10 minutes"))

    def start(sources):
        clean = ingest.topic_pipeline(sources[DELIVERY_TOPIC], DELIVERY_TOPIC)[0]
        return sinks.write_first_arrivals(clean, "delivery", STEP, layout, "first", available_now=True)

    arrive(spark, folder, {DELIVERY_TOPIC: once.unionAll(again)}, start)
    return read_lake(spark, layout.lakes[0], "delivery").select("package_id", "event_time", "status")


def stream_lake(spark, sf_dir):
    def start(clean, _, layout):
        return sinks.write_lake(clean, "delivery", layout, "lake_delivery", available_now=True)

    layout = _one(spark, sf_dir, "lake", DELIVERY_TOPIC, start)
    return read_lake(spark, layout.lakes[0], "delivery")


def stream_dual_write(spark, sf_dir):
    """Rows of each of two lakes written at once."""
    folder = work_folder(spark, "dual")
    layout = Layout([f"{folder}/a", f"{folder}/b"], folder)
    arrive(
        spark,
        folder,
        {ORDER_TOPIC: topic_records(spark, sf_dir, ORDER_TOPIC)},
        lambda sources: [
            sinks.write_topic(sources[ORDER_TOPIC], ORDER_TOPIC, layout, "lake_orders", True)
        ],
    )
    counts = [
        read_lake(spark, root, "order").agg(F.count("*").alias("n")).select(F.lit(i).alias("lake"), "n")
        for i, root in enumerate(layout.lakes)
    ]
    return counts[0].unionByName(counts[1])


def stream_dedup(spark, sf_dir):
    """Every record arrives twice, the middle piece last; each delivery step comes out once, late and
    untimed ones too."""
    folder = work_folder(spark, "dedup")
    layout = Layout([f"{folder}/lake"], folder)
    once = topic_records(spark, sf_dir, DELIVERY_TOPIC)

    def start(sources):
        clean = ingest.topic_pipeline(sources[DELIVERY_TOPIC], DELIVERY_TOPIC)[0]
        return [sinks.write_once(clean, "delivery", STEP, layout, "once", available_now=True)]

    arrive(spark, folder, {DELIVERY_TOPIC: once.unionAll(once)}, start, order=(0, 2, 1))
    return read_lake(spark, layout.lakes[0], "delivery").select("package_id", "event_time", "status")


def stream_two_writers(spark, sf_dir):
    """Two streams with checkpoints of their own write all records of the delivery topic, each to
    the same lake; rows of both are there. Positions and their enriching sink are not covered."""
    folder = work_folder(spark, "writers")
    lake = f"{folder}/lake"
    records = topic_records(spark, sf_dir, DELIVERY_TOPIC)
    records.write.parquet(f"{folder}/topics/{DELIVERY_TOPIC}")
    for work in ("first", "second"):
        source = read_topic_files(spark, f"{folder}/topics/{DELIVERY_TOPIC}")
        layout = Layout([lake], f"{folder}/{work}")
        sinks.write_topic(source, DELIVERY_TOPIC, layout, "lake_delivery", True).awaitTermination()
    return read_lake(spark, lake, "delivery")


def stream_dead_letter(spark, sf_dir):
    def start(_, rejected, layout):
        return [sinks.write_dead_letters(rejected, layout, "dlq_delivery", available_now=True)]

    layout = _one(spark, sf_dir, "dlq", DELIVERY_TOPIC, start)
    return spark.read.parquet(dead_letter_path(layout.lakes[0])).select(
        "kafka_key", "kafka_timestamp", "reject_topic", "reject_reason", "package_id", "order_id"
    )


def stream_state(spark, sf_dir):
    def start(clean, _, layout):
        return [sinks.write_vehicle_state(clean, layout, available_now=True)]

    layout = _one(spark, sf_dir, "state", GPS_TOPIC, start)
    return sinks.vehicle_states(layout).latest(spark).drop("updated_at")


def stream_topics(spark, sf_dir):
    """All four topics side by side: rows in the lake and in the dead letters, by event type."""
    folder = work_folder(spark, "topics")
    layout = Layout([f"{folder}/lake"], folder)
    records = {t: topic_records(spark, sf_dir, t) for t in TOPICS}
    arrive(spark, folder, records, lambda s: streams.start_topics(s, layout, available_now=True))
    dead = spark.read.parquet(dead_letter_path(layout.lakes[0]))
    counts = None
    for topic, event_type in EVENT_TYPE_BY_TOPIC.items():
        kept = read_lake(spark, layout.lakes[0], event_type).agg(F.count("*").alias("n_lake"))
        lost = dead.filter(F.col("reject_topic") == topic).agg(F.count("*").alias("n_rejected"))
        row = kept.crossJoin(lost).select(F.lit(event_type).alias("event_type"), "n_lake", "n_rejected")
        counts = row if counts is None else counts.unionByName(row)
    return counts


def stream_progress(spark, sf_dir):
    """Input rows per query, over its three runs."""
    folder = work_folder(spark, "progress")
    layout = Layout([f"{folder}/lake"], folder)

    def start(sources):
        return [
            q
            for topic in (ORDER_TOPIC, DRIVER_TOPIC)
            for q in sinks.write_lake(
                ingest.topic_pipeline(sources[topic], topic)[0],
                EVENT_TYPE_BY_TOPIC[topic],
                layout,
                streams.QUERY_NAMES[topic],
                available_now=True,
            )
        ]

    records = {t: topic_records(spark, sf_dir, t) for t in (ORDER_TOPIC, DRIVER_TOPIC)}
    counter = streams.RowCounter()
    spark.streams.addListener(counter)
    try:
        rows = {q.name: counter.of(q) for q in arrive(spark, folder, records, start)}
    finally:
        spark.streams.removeListener(counter)
    return spark.createDataFrame(list(rows.items()), "query_name string, n_input_rows bigint")


def stream_batches(spark, sf_dir):
    """Input rows of every batch of two queries over three runs, from the stored progress."""
    folder = work_folder(spark, "batches")
    layout = Layout([f"{folder}/lake"], folder)
    log = streams.ProgressLog(layout.state("progress"))

    def start(sources):
        return streams.start_topics(sources, layout, available_now=True)

    spark.streams.addListener(log)
    try:
        records = {t: topic_records(spark, sf_dir, t) for t in (ORDER_TOPIC, DRIVER_TOPIC)}
        log.settle(arrive(spark, folder, records, start))
        log.flush(spark)
    finally:
        spark.streams.removeListener(log)
    rows = streams.read_progress(spark, log.path).filter("query_name IN ('lake_orders', 'lake_drivers')")
    return rows.filter("n_input_rows > 0").select("query_name", "batch_id", "n_input_rows")


def stream_dual_rows(spark, sf_dir):
    """All rows of each of two lakes written at once, one of them compacted afterwards."""
    folder = work_folder(spark, "dual-rows")
    layout = Layout([f"{folder}/a", f"{folder}/b"], folder)

    def start(sources):
        return streams.start_topics(sources, layout, available_now=True)

    arrive(spark, folder, {ORDER_TOPIC: topic_records(spark, sf_dir, ORDER_TOPIC)}, start)
    manifest.compact(spark, layout.lakes[1], "order", at_least=1)
    manifest.vacuum(spark, layout.lakes[1], "order")
    rows = [read_lake(spark, root, "order").withColumn("lake", F.lit(i)) for i, root in enumerate(layout.lakes)]
    return rows[0].unionByName(rows[1])


def _lake_in_two_steps(spark, sf_dir, purpose, event_type=None, load=True):
    """A lake, of one event type or all, whose second half is written after the first was loaded
    into RAW."""
    only = event_type
    folder = work_folder(spark, purpose)
    tables, summary = {}, None
    for topic, event_type in EVENT_TYPE_BY_TOPIC.items():
        if only not in (None, event_type):
            continue
        clean = ingest.topic_pipeline(topic_records(spark, sf_dir, topic), topic)[0]
        clean = held(clean, f"{folder}/clean/{event_type}")
        if topic == GPS_TOPIC:
            # no cut can be made before enriching, which reads its rows several times
            clean = held(enrich_gps(clean), f"{folder}/enriched")
        tables[event_type] = pieces(ingest.with_lake_columns(clean, event_type), "kafka_timestamp", 2)
    for i in range(2):
        for event_type, parts in tables.items():
            # Few files per day; a large day is split by adaptive execution.
            rows = parts[i].hint("rebalance", "event_date")
            rows.write.partitionBy("event_date", "event_type").mode("append").parquet(
                lake_path(f"{folder}/lake", event_type)
            )
        if load:
            summary = load_events(spark, f"{folder}/lake", f"{folder}/raw", only)
        if load and i == 0:
            summary.collect()
    return folder, summary


def incremental_load(spark, sf_dir):
    """Summary of the second load, which sees the second half of the lake only."""
    _, summary = _lake_in_two_steps(spark, sf_dir, "load")
    return summary.drop("n_files")


def load_outcomes(spark, sf_dir):
    """Files, rows and unreadable files of three loads: the first half of the orders with one file a day, the
    second half beside a broken file, and a load that finds nothing new."""
    folder = work_folder(spark, "outcomes")
    clean = ingest.topic_pipeline(topic_records(spark, sf_dir, ORDER_TOPIC), ORDER_TOPIC)[0]
    path = lake_path(f"{folder}/lake", "order")
    halves = pieces(ingest.with_lake_columns(clean, "order"), "kafka_timestamp", 2)
    found = []
    for step in range(3):
        if step < 2:
            rows = halves[step].repartition("event_date")
            rows.write.partitionBy("event_date", "event_type").mode("append").parquet(path)
        if step == 1:
            write_file(spark, f"{path}/event_date=2024-01-01/event_type=order/broken.parquet", b"no parquet")
        summary = load_events(spark, f"{folder}/lake", f"{folder}/raw", "order")
        found.append(spark.createDataFrame(summary.select(F.lit(step).alias("step"), "*").collect(), f"step int, {LOAD_SUMMARY}"))
    return reduce(DataFrame.unionByName, found)


def reloaded_empty(spark, sf_dir):
    """Rows of the RAW orders after a load, a full reload of an empty lake, and a full reload of the lake."""
    folder, _ = _lake_in_two_steps(spark, sf_dir, "emptied", "order")
    seen = []
    for i, lake in enumerate(["lake", "nothing", "lake"]):
        load_events(spark, f"{folder}/{lake}", f"{folder}/raw", "order", truncate=i > 0).collect()
        rows = read_raw(spark, f"{folder}/raw", "orders").agg(F.count("*").alias("n_rows"))
        seen.append(rows.select(F.lit(i).alias("step"), "n_rows"))
    return seen[0].unionByName(seen[1]).unionByName(seen[2])


def loaded_gps(spark, sf_dir):
    """RAW positions after two incremental loads and one that finds nothing new."""
    folder, _ = _lake_in_two_steps(spark, sf_dir, "loaded", "gps")
    load_events(spark, f"{folder}/lake", f"{folder}/raw", "gps").collect()
    return read_raw(spark, f"{folder}/raw", "gps_events").drop("load_timestamp")


def reloaded_orders(spark, sf_dir):
    """RAW orders after an incremental load and a full reload."""
    folder, _ = _lake_in_two_steps(spark, sf_dir, "reloaded", "order")
    load_events(spark, f"{folder}/lake", f"{folder}/raw", "order", truncate=True).collect()
    return read_raw(spark, f"{folder}/raw", "orders").drop("load_timestamp")


def lake_inventory(spark, sf_dir):
    """Files and bytes per event type of a lake with one file per day."""
    folder = work_folder(spark, "inventory")
    for topic, event_type in EVENT_TYPE_BY_TOPIC.items():
        clean = ingest.topic_pipeline(topic_records(spark, sf_dir, topic), topic)[0]
        rows = ingest.with_lake_columns(clean, event_type).repartition("event_date")
        rows.write.partitionBy("event_date", "event_type").parquet(lake_path(f"{folder}/lake", event_type))
    found = file_inventory(spark, f"{folder}/lake")
    return found.select("event_type", "n_files", (F.col("n_bytes") > 0).alias("has_bytes"))


def send_loads(raw: dict[str, DataFrame], folder: str) -> None:
    """RAW tables, each made once, with the rows of every load in a folder of their own."""

    def send(table: str) -> None:
        rows = raw[table]
        typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[table].fields])
        cut = typed.withColumn("load_batch", piece(typed, "load_timestamp"))
        cut.write.partitionBy("load_batch").parquet(f"{folder}/{table}")

    with ThreadPoolExecutor() as pool:
        list(pool.map(send, raw))


def _refreshed(spark, sf_dir, name):
    """A fact refreshed after each of three loads of RAW, which come in order of their load times."""
    folder = work_folder(spark, "refreshed")
    send_loads(raw_tables(spark, sf_dir), f"{folder}/sent")
    for batch in range(3):
        for table in RAW_SCHEMAS:
            sent = f"{folder}/sent/{table}/load_batch={batch}"
            if file_exists(spark, sent):
                publish_folder(spark, sent, f"{folder}/raw/{table}/generation=0/load_batch={batch}")
        refresh_facts(spark, f"{folder}/raw", f"{folder}/facts", tested=batch == 2)
    return read_fact(spark, f"{folder}/facts", name)


def refreshed_deliveries(spark, sf_dir):
    """The delivery fact after three loads, each of which changed a part of it."""
    return _refreshed(spark, sf_dir, "fct_deliveries").drop("delivery_day")


def refreshed_activity(spark, sf_dir):
    """The daily fact after three loads, each of which changed some days."""
    return _refreshed(spark, sf_dir, "fct_daily_activity")


def batch_tables(spark, sf_dir):
    """Rows of all tables that the batch job publishes in its schema."""
    out = work_folder(spark, "published")
    tables = jobs.run_batch(spark, raw_tables(spark, sf_dir), out, schema="checked")
    counts = [
        spark.table(f"checked.{name}").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name in tables
    ]
    return reduce(DataFrame.unionByName, counts)


def batch_job(spark, sf_dir):
    """The whole batch job with its gates; returns the daily fact as stored."""
    out = work_folder(spark, "batch")
    tables = jobs.run_batch(spark, raw_tables(spark, sf_dir), out)
    return tables["fct_daily_activity"].drop("mart_refreshed_at")


STREAM_QUERIES = {
    fn.__name__: fn
    for fn in [
        stream_lake,
        stream_dual_write,
        stream_dedup,
        stream_first_arrivals,
        stream_two_writers,
        stream_dead_letter,
        stream_state,
        stream_topics,
        stream_progress,
        stream_batches,
        stream_dual_rows,
        incremental_load,
        load_outcomes,
        loaded_gps,
        reloaded_orders,
        reloaded_empty,
        lake_inventory,
        batch_job,
        batch_tables,
        refreshed_deliveries,
        refreshed_activity,
    ]
}
