"""The streaming job: start, watch and stop the queries."""

import threading
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from convoy.schemas import DELIVERY_TOPIC, DRIVER_TOPIC, GPS_TOPIC, ORDER_TOPIC, struct_of
from convoy.sources.lake import read_parquet_or_empty
from convoy.sources.topics import read_topic
from convoy.streaming.layout import Layout
from convoy.streaming.sinks import write_topic

QUERY_NAMES = {
    GPS_TOPIC: "lake_gps",
    DELIVERY_TOPIC: "lake_delivery",
    ORDER_TOPIC: "lake_orders",
    DRIVER_TOPIC: "lake_drivers",
}

#: ``started_at`` is the ISO time the batch began; state rows and dropped rows are sums over stateful operators.
BATCHES = struct_of(
    "query_name string, query_id string, batch_id bigint, started_at string, n_input_rows bigint, "
    "duration_ms bigint, n_state_rows bigint, n_dropped_late bigint"
)
PROGRESS_COLUMNS = "query_name string, batch_id bigint, n_input_rows bigint, status string"


def start_topics(
    records: dict[str, DataFrame], layout: Layout, available_now: bool = False
) -> list[StreamingQuery]:
    """One named query per topic, all running side by side."""
    return [
        write_topic(stream, topic, layout, QUERY_NAMES[topic], available_now)
        for topic, stream in records.items()
    ]


def run_stream(
    spark: SparkSession, servers: str, layout: Layout, max_offsets_per_trigger: int | None = None
) -> None:
    """Read the four topics from a broker and process them until interrupted.

    Every query has a scheduler pool of its own name; the progress of all batches is stored below ``layout.work``.
    """
    log = ProgressLog(layout.state("progress"))
    spark.streams.addListener(log)
    try:
        queries = start_topics(
            {topic: read_topic(spark, topic, servers, max_offsets_per_trigger) for topic in QUERY_NAMES},
            layout,
        )
        watch(spark, queries=queries, log=log)
    finally:
        spark.streams.removeListener(log)


def progress(spark: SparkSession, queries: list[StreamingQuery] | None = None) -> DataFrame:
    """Last batch, rows and status of every query: one row per query, known to the driver anyway."""
    rows = []
    for query in spark.streams.active if queries is None else queries:
        last = query.lastProgress
        rows.append(
            (
                query.name,
                last["batchId"] if last else None,
                last["numInputRows"] if last else None,
                "failed" if query.exception() else query.status["message"],
            )
        )
    return spark.createDataFrame(rows, PROGRESS_COLUMNS)


class ProgressLog(StreamingQueryListener):
    """Every batch of every query as a row of a table, once added to ``spark.streams``.

    Events are kept until ``flush`` appends them: the listener itself starts no job, so it never holds up a stream.
    ``watch`` flushes at each round.
    """

    def __init__(self, path: str):
        self.path = path
        self.waiting: list[tuple] = []
        self.ended: set[str] = set()
        self.lock = threading.Lock()

    def onQueryStarted(self, event):
        self.ended.discard(str(event.id))

    def onQueryProgress(self, event):
        p = event.progress
        states = p.stateOperators
        row = (
            p.name,
            str(p.id),
            p.batchId,
            p.timestamp,
            p.numInputRows,
            p.durationMs.get("triggerExecution"),
            sum(s.numRowsTotal for s in states),
            sum(s.numRowsDroppedByWatermark for s in states),
        )
        with self.lock:
            self.waiting.append(row)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.id))

    def settle(self, queries: list[StreamingQuery], patience: float = 30) -> None:
        """Wait until what ended queries have reported is here."""
        until = time.time() + patience
        while time.time() < until and any(not q.isActive and str(q.id) not in self.ended for q in queries):
            time.sleep(0.05)

    def flush(self, spark: SparkSession) -> None:
        with self.lock:
            rows, self.waiting = self.waiting, []
        if rows:
            spark.createDataFrame(rows, BATCHES).coalesce(1).write.mode("append").parquet(self.path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The batches that progress logs have stored."""
    return read_parquet_or_empty(spark, path, BATCHES)


class RowCounter(StreamingQueryListener):
    """Input rows of every query since the counter was added to ``spark.streams``, by query id."""

    def __init__(self):
        self.rows: dict[str, int] = defaultdict(int)
        self.ended: set[str] = set()

    def onQueryStarted(self, event):
        self.ended.discard(str(event.id))

    def onQueryProgress(self, event):
        self.rows[str(event.progress.id)] += event.progress.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.id))

    def of(self, query: StreamingQuery, patience: float = 30) -> int:
        """Rows of a query; if it has ended, with all that the listener is still to hear."""
        until = time.time() + patience
        while not query.isActive and str(query.id) not in self.ended and time.time() < until:
            time.sleep(0.05)
        return self.rows[str(query.id)]


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()


def failures(queries: list[StreamingQuery]) -> list[Exception]:
    return [e for e in (q.exception() for q in queries if not q.isActive) if e is not None]


def watch(
    spark: SparkSession,
    every_seconds: float = 30,
    queries: list[StreamingQuery] | None = None,
    log: ProgressLog | None = None,
) -> None:
    """Print the progress, and store that of all batches in ``log``, until interrupted, until all queries have
    ended or until one fails; then stop all queries, and raise what the failed one raised."""
    queries = spark.streams.active if queries is None else queries
    try:
        while any(q.isActive for q in queries) and not failures(queries):
            progress(spark, queries).orderBy(F.col("query_name")).show(truncate=False)
            if log is not None:
                log.flush(spark)
            time.sleep(every_seconds)
    except KeyboardInterrupt:
        pass
    finally:
        stop_all(spark)
        if log is not None:
            log.settle(queries)
            log.flush(spark)
    for failure in failures(queries):
        raise failure
