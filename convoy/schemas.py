"""Fixed schemas and vocabularies of the event topics, the RAW tables and the lake."""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Topic names, required keys, status words, bounding box and thresholds must
# equal the ones the event producers and the dashboards use.

GPS_TOPIC = "gps_positions"
DELIVERY_TOPIC = "delivery_events"
ORDER_TOPIC = "orders"
DRIVER_TOPIC = "driver_events"

REQUIRED_KEYS = {
    GPS_TOPIC: ["vehicle_id", "driver_id"],
    DELIVERY_TOPIC: ["package_id", "order_id", "vehicle_id"],
    ORDER_TOPIC: ["order_id", "package_id"],
    DRIVER_TOPIC: ["driver_id", "vehicle_id"],
}

REJECT_REASON = "missing_required_key"

DELIVERY_STATUSES = ["created", "picked_up", "in_transit", "delivered", "failed"]
ORDER_STATUSES = ["created"]
DRIVER_STATUSES = ["offline", "online", "on_break", "delivering"]
STAGED_DELIVERY_STATUSES = ["picked_up", "in_transit", "delivered", "failed"]
FINAL_STATUSES = ["delivered", "failed", "in_transit", "picked_up", "pending"]

ANOMALY_TYPES = ["SPEED_TOO_HIGH", "SPEED_MISMATCH", "IMMOBILE", "GPS_JUMP"]

LAT_MIN, LAT_MAX = 45.0, 46.5
LON_MIN, LON_MAX = -74.5, -73.0

EARTH_RADIUS_KM = 6371.0
IMMOBILE_BELOW_KMH = 1.0
MAX_SPEED_KMH = 130.0
MAX_SPEED_GAP_KMH = 50.0
MAX_STEP_KM = 2.0

STATE_TTL_SECONDS = 86400
CALENDAR_MARGIN_DAYS = 30
# ----------------------------------------------------------------------------


_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def struct_of(columns: str) -> T.StructType:
    """Schema from ``"name type, name type"``; unlike ``fromDDL`` it needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TOPIC_SCHEMAS = {
    GPS_TOPIC: struct_of(
        "vehicle_id string, driver_id string, lat double, lon double, "
        "speed_kmh double, timestamp string"
    ),
    DELIVERY_TOPIC: struct_of(
        "package_id string, order_id string, vehicle_id string, status string, "
        "lat double, lon double, timestamp string"
    ),
    ORDER_TOPIC: struct_of(
        "order_id string, package_id string, dest_lat double, dest_lon double, "
        "status string, timestamp string"
    ),
    DRIVER_TOPIC: struct_of(
        "driver_id string, vehicle_id string, status string, lat double, "
        "lon double, timestamp string"
    ),
}

# Layout of a topic record, whichever source delivers it.
ENVELOPE_SCHEMA = struct_of(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

# Event type: the word used in lake paths, partitions and gauges.
EVENT_TYPE_BY_TOPIC = {
    GPS_TOPIC: "gps",
    DELIVERY_TOPIC: "delivery",
    ORDER_TOPIC: "order",
    DRIVER_TOPIC: "driver",
}
EVENT_TYPES = list(EVENT_TYPE_BY_TOPIC.values())

RAW_TABLE_BY_EVENT_TYPE = {
    "gps": "gps_events",
    "delivery": "delivery_events",
    "order": "orders",
    "driver": "driver_events",
}

RAW_SCHEMAS = {
    "gps_events": struct_of(
        "vehicle_id string, driver_id string, lat double, lon double, speed_kmh double, "
        "event_time timestamp, load_timestamp timestamp"
    ),
    "delivery_events": struct_of(
        "package_id string, order_id string, vehicle_id string, driver_id string, "
        "status string, event_time timestamp, load_timestamp timestamp"
    ),
    "orders": struct_of(
        "order_id string, package_id string, status string, "
        "event_time timestamp, load_timestamp timestamp"
    ),
    "driver_events": struct_of(
        "driver_id string, vehicle_id string, status string, "
        "event_time timestamp, load_timestamp timestamp"
    ),
}

_ENRICHMENT_FIELDS = (
    "prev_lat double, prev_lon double, prev_event_time timestamp, distance_km double, "
    "elapsed_seconds bigint, computed_speed_kmh double, is_immobile boolean, "
    "anomaly_types array<string>, is_anomaly boolean"
)


def _lake_schema(topic: str) -> T.StructType:
    fields = list(struct_of("kafka_key string, kafka_timestamp timestamp").fields)
    fields += TOPIC_SCHEMAS[topic].fields
    fields += struct_of("event_time timestamp").fields
    if topic == GPS_TOPIC:
        fields += struct_of(_ENRICHMENT_FIELDS).fields
    fields += struct_of("event_date date, event_type string").fields
    return T.StructType(fields)


LAKE_SCHEMAS = {
    event_type: _lake_schema(topic) for topic, event_type in EVENT_TYPE_BY_TOPIC.items()
}

#: Lake rows with the partition columns that name the stream and the batch that wrote them.
STORED_EVENTS = {
    event_type: T.StructType([*lake.fields, *struct_of("writer_id string, batch_id bigint").fields])
    for event_type, lake in LAKE_SCHEMAS.items()
}


def topic_schema(topic: str) -> T.StructType:
    """Schema of a topic's JSON payload; an undeclared topic is a ``KeyError``."""
    if topic not in TOPIC_SCHEMAS:
        raise KeyError(f"no schema declared for topic {topic!r}")
    return TOPIC_SCHEMAS[topic]
