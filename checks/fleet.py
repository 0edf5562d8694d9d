"""Fleet tables and topic records derived from the whole ``events`` table.

The RAW texts run unchanged in Spark and in DuckDB, so a query and its oracle start from the same
rows. They hold out-of-area points, unknown and negative speeds, un-normalised statuses and events
that were loaded again later.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.schemas import (
    DELIVERY_TOPIC,
    DRIVER_TOPIC,
    ENVELOPE_SCHEMA,
    GPS_TOPIC,
    ORDER_TOPIC,
)
from convoy.session import utc

RAW_SQL = {
    "gps_events": """
 SELECT vehicle_id, driver_id, lat, lon, speed_kmh, event_time, load_timestamp FROM (
  SELECT 'veh-' || CAST(user_id % 28 AS VARCHAR(20)) AS vehicle_id,
   'drv-' || CAST(user_id % 32 AS VARCHAR(20)) AS driver_id,
   CASE WHEN event_id % 50 = 0 THEN 48.85e0 ELSE 45.4e0 + 0.03e0 * (event_id * 37 % 10) END AS lat,
   -73.95e0 + 0.04e0 * (event_id * 37 % 10) AS lon,
   CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 41 = 0 THEN -1.0e0 ELSE value END AS speed_kmh,
   ts AS event_time, ts + INTERVAL '1' MINUTE AS load_timestamp
  FROM {events}
  UNION ALL
  SELECT 'veh-' || CAST(user_id % 28 AS VARCHAR(20)), 'drv-' || CAST(user_id % 32 AS VARCHAR(20)),
   45.4e0 + 0.03e0 * (event_id * 37 % 10), -73.95e0 + 0.04e0 * (event_id * 37 % 10),
   value + 1.0e0, ts, ts + INTERVAL '61' MINUTE
  FROM {events} WHERE event_type = 'error')""",
    "delivery_events": """
 SELECT package_id, order_id, vehicle_id, CAST(NULL AS VARCHAR(20)) AS driver_id, status,
  event_time, load_timestamp FROM (
  SELECT 'pkg-' || CAST(p AS VARCHAR(20)) AS package_id, 'ord-' || CAST(p AS VARCHAR(20)) AS order_id,
   'veh-' || CAST(p % 28 AS VARCHAR(20)) AS vehicle_id,
   CASE step WHEN 0 THEN 'picked_up' WHEN 1 THEN 'in_transit'
     WHEN 2 THEN (CASE WHEN p % 12 = 0 THEN 'failed' ELSE 'delivered' END) ELSE 'created' END AS status,
   ts AS event_time, ts + INTERVAL '1' MINUTE AS load_timestamp
  FROM (SELECT CAST(floor(event_id / 4) AS BIGINT) AS p, event_id % 4 AS step, ts FROM {events})
  UNION ALL
  SELECT 'pkg-' || CAST(p AS VARCHAR(20)), 'ord-' || CAST(p AS VARCHAR(20)),
   'veh-' || CAST((p + 1) % 28 AS VARCHAR(20)), CASE step WHEN 0 THEN 'picked_up' ELSE 'in_transit' END,
   ts, ts + INTERVAL '61' MINUTE
  FROM (SELECT CAST(floor(event_id / 4) AS BIGINT) AS p, event_id % 4 AS step, ts FROM {events}
        WHERE event_type = 'signup'))""",
    "orders": """
 SELECT order_id, package_id, status, event_time, load_timestamp FROM (
  SELECT 'ord-' || CAST(p AS VARCHAR(20)) AS order_id, 'pkg-' || CAST(p AS VARCHAR(20)) AS package_id,
   'created' AS status, first_ts - INTERVAL '45' MINUTE AS event_time, first_ts AS load_timestamp
  FROM (SELECT CAST(floor(event_id / 4) AS BIGINT) AS p, min(ts) AS first_ts FROM {events}
        GROUP BY CAST(floor(event_id / 4) AS BIGINT))
  UNION ALL
  SELECT 'ord-' || CAST(p AS VARCHAR(20)), 'pkg-' || CAST(p AS VARCHAR(20)), ' Created ',
   last_ts - INTERVAL '44' MINUTE, last_ts + INTERVAL '1' HOUR
  FROM (SELECT CAST(floor(event_id / 4) AS BIGINT) AS p, max(ts) AS last_ts FROM {events}
        WHERE event_type = 'purchase' GROUP BY CAST(floor(event_id / 4) AS BIGINT)))""",
    "driver_events": """
 SELECT driver_id, vehicle_id, status, event_time, load_timestamp FROM (
  SELECT 'drv-' || CAST(user_id % 32 AS VARCHAR(20)) AS driver_id,
   'veh-' || CAST(event_id * 5 % 28 AS VARCHAR(20)) AS vehicle_id,
   CASE event_type WHEN 'signup' THEN 'online' WHEN 'click' THEN 'delivering' WHEN 'error' THEN 'offline'
     WHEN 'view' THEN 'on_break' ELSE ' Online ' END AS status,
   ts + INTERVAL '12' HOUR AS event_time, ts + INTERVAL '13' HOUR AS load_timestamp
  FROM {events}
  UNION ALL
  SELECT 'drv-' || CAST(user_id % 32 AS VARCHAR(20)), 'veh-' || CAST(event_id * 5 % 28 AS VARCHAR(20)),
   'delivering', ts + INTERVAL '12' HOUR, ts + INTERVAL '14' HOUR
  FROM {events} WHERE event_type = 'signup')""",
}

# The payload fields of every topic before some of them are spoilt.
PAYLOAD_SQL = {
    GPS_TOPIC: """
 SELECT event_id, ts, 'veh-' || CAST(user_id % 28 AS VARCHAR(20)) AS vehicle_id,
  'drv-' || CAST(user_id % 32 AS VARCHAR(20)) AS driver_id,
  CASE WHEN event_id % 50 = 0 THEN 48.85e0 ELSE 45.4e0 + 0.03e0 * (event_id * 37 % 10) END AS lat,
  -73.95e0 + 0.04e0 * (event_id * 37 % 10) AS lon, value AS speed_kmh FROM {events}""",
    DELIVERY_TOPIC: """
 SELECT event_id, ts, 'pkg-' || CAST(CAST(floor(event_id / 4) AS BIGINT) AS VARCHAR(20)) AS package_id,
  'ord-' || CAST(CAST(floor(event_id / 4) AS BIGINT) AS VARCHAR(20)) AS order_id,
  'veh-' || CAST(CAST(floor(event_id / 4) AS BIGINT) % 28 AS VARCHAR(20)) AS vehicle_id,
  CASE event_id % 4 WHEN 0 THEN ' Picked_Up ' WHEN 1 THEN 'in_transit' WHEN 2 THEN 'DELIVERED' ELSE 'created' END AS status,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 45.4e0 + 0.03e0 * (event_id * 37 % 10) END AS lat,
  CASE WHEN event_id % 50 = 0 THEN 2.35e0 ELSE -73.95e0 + 0.04e0 * (event_id * 37 % 10) END AS lon FROM {events}""",
    ORDER_TOPIC: """
 SELECT event_id, ts, 'ord-' || CAST(event_id AS VARCHAR(20)) AS order_id,
  'pkg-' || CAST(event_id AS VARCHAR(20)) AS package_id,
  45.4e0 + 0.03e0 * (event_id * 37 % 10) AS dest_lat, -73.95e0 + 0.04e0 * (event_id * 37 % 10) AS dest_lon,
  ' Created' AS status FROM {events}""",
    DRIVER_TOPIC: """
 SELECT event_id, ts, 'drv-' || CAST(user_id % 32 AS VARCHAR(20)) AS driver_id,
  'veh-' || CAST(event_id * 5 % 28 AS VARCHAR(20)) AS vehicle_id,
  CASE event_type WHEN 'signup' THEN 'online' WHEN 'click' THEN 'DELIVERING' WHEN 'error' THEN 'offline'
    WHEN 'view' THEN 'on_break' ELSE ' Online ' END AS status,
  45.4e0 + 0.03e0 * (event_id * 37 % 10) AS lat, -73.95e0 + 0.04e0 * (event_id * 37 % 10) AS lon FROM {events}""",
}

RECORD_KEY = {
    GPS_TOPIC: "vehicle_id",
    DELIVERY_TOPIC: "package_id",
    ORDER_TOPIC: "package_id",
    DRIVER_TOPIC: "driver_id",
}
# The key that some payloads lack.
LOST_KEY = {
    GPS_TOPIC: "vehicle_id",
    DELIVERY_TOPIC: "order_id",
    ORDER_TOPIC: "order_id",
    DRIVER_TOPIC: "vehicle_id",
}


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def spread(events: DataFrame) -> DataFrame:
    """The events over all tasks: a file of few row groups is read by few, whatever the work on its rows."""
    return events.repartition("event_id")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = read_events(spark, sf_dir)
    return {name: spark.sql(text, events=events) for name, text in RAW_SQL.items()}


def topic_records(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """Topic records: one of 37 payloads is no JSON, one of 31 lacks a key and has the time ``x``,
    one of 29 has an unreadable time."""
    payload = spark.sql(PAYLOAD_SQL[topic], events=spread(read_events(spark, sf_dir)))
    number = F.col("event_id")
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    time = (
        F.when(number % 31 == 0, "x").when(number % 29 == 0, "not-a-date").otherwise(iso)
    )
    fields = [
        F.when(number % 31 != 0, F.col(c)).alias(c) if c == LOST_KEY[topic] else F.col(c)
        for c in payload.columns
        if c not in ("event_id", "ts")
    ]
    text = F.when(number % 37 == 0, "{broken").otherwise(
        F.to_json(F.struct(*fields, time.alias("timestamp")))
    )
    return payload.select(
        F.col(RECORD_KEY[topic]).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        number.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ).to(ENVELOPE_SCHEMA)
