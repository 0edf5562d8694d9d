"""One query per operator: ``name -> fn(spark, sf_dir)``.

Times leave as TIMESTAMP_NTZ and arrays as text, so that results compare with another engine.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import streams
from checks.fleet import raw_tables, topic_records
from convoy.plans import enrich, gauges, ingest, jobs, marts, quality, staging, state, worksheet
from convoy.schemas import (
    DELIVERY_TOPIC,
    DRIVER_TOPIC,
    EVENT_TYPE_BY_TOPIC,
    GPS_TOPIC,
    ORDER_TOPIC,
    RAW_TABLE_BY_EVENT_TYPE,
)
from convoy.session import work_folder
from convoy.sources.topics import parse_events

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = "2024-03-01 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def comparable(df: DataFrame) -> DataFrame:
    """Local times without zone; arrays joined by commas."""
    shown = []
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        column = F.col(field.name)
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind == "array":
            column = F.array_join(column, ",")
        shown.append(column.alias(field.name))
    return df.select(*shown)


def stored(spark, tables, purpose):
    """The tables as written once, for queries that read them several times."""
    folder, found = work_folder(spark, purpose), {}
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}")
        found[name] = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
    return found


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def stage(spark, sf_dir, *names):
    """Staging tables by name, built from the RAW tables."""
    raw = raw_tables(spark, sf_dir)
    found = [staging.STAGING[n][0](raw[staging.STAGING[n][1]]) for n in names]
    return found[0] if len(found) == 1 else found


# --- topics ------------------------------------------------------------------

PARSE_NAMES = {
    "parse_events_gps": GPS_TOPIC,
    "parse_events_delivery": DELIVERY_TOPIC,
    "parse_events_orders": ORDER_TOPIC,
    "parse_events_driver": DRIVER_TOPIC,
}
for _name, _topic in PARSE_NAMES.items():
    QUERIES[_name] = lambda spark, sf_dir, topic=_topic: comparable(
        parse_events(topic_records(spark, sf_dir, topic), topic)
    )


@query
def validity_counts(spark, sf_dir):
    counts = [
        ingest.count_validity(parse_events(topic_records(spark, sf_dir, t), t), t).select(
            F.lit(t).alias("topic"), "is_valid", F.col("count").alias("n")
        )
        for t in PARSE_NAMES.values()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def valid_split(spark, sf_dir):
    records = topic_records(spark, sf_dir, DELIVERY_TOPIC)
    valid, _ = ingest.split_valid_invalid(parse_events(records, DELIVERY_TOPIC), DELIVERY_TOPIC)
    return comparable(valid)


@query
def dead_letter(spark, sf_dir):
    rejected = [
        ingest.topic_pipeline(topic_records(spark, sf_dir, t), t)[1]
        .transform(ingest.with_reject_date, F.to_date(as_of()))
        .select("reject_topic", "reject_reason", "reject_date", "kafka_key", "kafka_timestamp")
        for t in PARSE_NAMES.values()
    ]
    return comparable(reduce(DataFrame.unionByName, rejected))


@query
def rejected_by_reason(spark, sf_dir):
    counts = [
        ingest.rejected_by_reason(topic_records(spark, sf_dir, t), t) for t in PARSE_NAMES.values()
    ]
    return reduce(DataFrame.unionByName, counts).withColumnRenamed("count", "n")


def clean(spark, sf_dir, topic):
    return ingest.topic_pipeline(topic_records(spark, sf_dir, topic), topic)[0]


@query
def clean_events(spark, sf_dir):
    """Delivery events: times, statuses, service area."""
    return comparable(clean(spark, sf_dir, DELIVERY_TOPIC))


@query
def clean_gps(spark, sf_dir):
    return comparable(clean(spark, sf_dir, GPS_TOPIC))


def _valid(topic):
    def run(spark, sf_dir):
        events = parse_events(topic_records(spark, sf_dir, topic), topic)
        return comparable(ingest.split_valid_invalid(events, topic)[0])

    return run


# The delivery topic is in valid_split and clean_events, positions are in clean_gps.
for _name, _topic in {"gps": GPS_TOPIC, "orders": ORDER_TOPIC, "driver": DRIVER_TOPIC}.items():
    QUERIES[f"valid_{_name}"] = _valid(_topic)
for _name, _topic in {"orders": ORDER_TOPIC, "driver": DRIVER_TOPIC}.items():
    QUERIES[f"clean_{_name}"] = lambda spark, sf_dir, topic=_topic: comparable(clean(spark, sf_dir, topic))


# --- enrichment --------------------------------------------------------------

ROUNDED = ["distance_km", "computed_speed_kmh"]


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ROUNDED if c in df.columns})


def positions(spark, sf_dir):
    """Staged positions under the names they have in the lake."""
    return stage(spark, sf_dir, "stg_gps_events").select(
        "vehicle_id",
        F.col("latitude").alias("lat"),
        F.col("longitude").alias("lon"),
        "speed_kmh",
        "event_time",
    )


@query
def movement_metrics(spark, sf_dir):
    return comparable(rounded(enrich.add_movement_metrics(positions(spark, sf_dir), distinct=True)))


@query
def movement_metrics_hot(spark, sf_dir):
    """One vehicle, one instant of it and one hour hold most of the positions."""
    usual = F.col("vehicle_id").like("veh-1%")
    start = F.lit("2024-01-10 00:00:00").cast("timestamp")
    minute = F.minute("event_time")
    crowd = F.when(minute < 40, start).otherwise(start + F.make_dt_interval(mins=minute))
    hot = positions(spark, sf_dir).withColumns(
        {
            "vehicle_id": F.when(usual, F.col("vehicle_id")).otherwise("veh-hot"),
            "event_time": F.when(usual, F.col("event_time")).otherwise(crowd),
        }
    )
    return comparable(rounded(enrich.add_movement_metrics(hot)))


@query
def anomaly_flags(spark, sf_dir):
    flagged = enrich.enrich_gps(positions(spark, sf_dir), distinct=True)
    return comparable(flagged.select("vehicle_id", "event_time", "anomaly_types", "is_anomaly"))


def gps_lake(spark, sf_dir):
    return ingest.with_lake_columns(enrich.enrich_gps(clean(spark, sf_dir, GPS_TOPIC)), "gps")


@query
def gps_enriched(spark, sf_dir):
    return comparable(rounded(gps_lake(spark, sf_dir)))


@query
def anomaly_counts(spark, sf_dir):
    return gauges.lake_gauges("gps", gps_lake(spark, sf_dir), as_of()).filter(
        "metric = 'delivery_lake_anomalies_total'"
    )


# --- staging -----------------------------------------------------------------

for _name in staging.STAGING:
    QUERIES[_name] = lambda spark, sf_dir, name=_name: comparable(stage(spark, sf_dir, name))


# --- marts -------------------------------------------------------------------


@query
def asof_driver(spark, sf_dir):
    deliveries, drivers = stage(spark, sf_dir, "stg_delivery_events", "stg_driver_events")
    return comparable(marts.deliveries_with_driver(deliveries, drivers))


@query
def delivery_pivot(spark, sf_dir):
    deliveries, drivers = stage(spark, sf_dir, "stg_delivery_events", "stg_driver_events")
    return comparable(marts.delivery_pivot(marts.deliveries_with_driver(deliveries, drivers)))


@query
def fct_deliveries(spark, sf_dir):
    return comparable(
        marts.fct_deliveries(
            *stage(spark, sf_dir, "stg_delivery_events", "stg_orders", "stg_driver_events")
        )
    )


def rollup(spark, sf_dir):
    return marts.gps_day_rollup(stage(spark, sf_dir, "stg_gps_events"))


@query
def gps_daily(spark, sf_dir):
    return marts.gps_daily(rollup(spark, sf_dir))


@query
def delivery_daily(spark, sf_dir):
    return marts.delivery_daily(stage(spark, sf_dir, "stg_delivery_events"))


@query
def fct_daily_activity(spark, sf_dir):
    gps, deliveries = stage(spark, sf_dir, "stg_gps_events", "stg_delivery_events")
    return marts.fct_daily_activity(marts.gps_day_rollup(gps), deliveries)


@query
def dim_vehicles(spark, sf_dir):
    return marts.dim_vehicles(rollup(spark, sf_dir))


@query
def dim_drivers(spark, sf_dir):
    drivers, deliveries = stage(spark, sf_dir, "stg_driver_events", "stg_delivery_events")
    return comparable(marts.dim_drivers(drivers, deliveries))


@query
def dim_drivers_resolved(spark, sf_dir):
    drivers, deliveries = stage(spark, sf_dir, "stg_driver_events", "stg_delivery_events")
    resolved = marts.deliveries_with_driver(deliveries, drivers)
    return comparable(marts.dim_drivers(drivers, resolved))


@query
def dim_date(spark, sf_dir):
    return marts.dim_date(fct_daily_activity(spark, sf_dir), today=F.to_date(as_of()))


@query
def dim_date_long(spark, sf_dir):
    """The calendar of an activity whose days lie twenty times as far apart."""
    first = F.lit("2024-01-01").cast("date")
    days = fct_daily_activity(spark, sf_dir).select(
        F.date_add(first, 20 * F.datediff("activity_date", first)).alias("activity_date")
    )
    return marts.dim_date(days, today=F.to_date(as_of()))


@query
def kpi_cards(spark, sf_dir):
    gps, deliveries, orders, drivers = stage(
        spark, sf_dir, "stg_gps_events", "stg_delivery_events", "stg_orders", "stg_driver_events"
    )
    day_rollup = marts.gps_day_rollup(gps)
    return marts.kpi_cards(
        marts.fct_deliveries(deliveries, orders, drivers),
        marts.dim_vehicles(day_rollup),
        marts.dim_drivers(drivers, deliveries),
        marts.fct_daily_activity(day_rollup, deliveries),
    )


# --- worksheet ---------------------------------------------------------------


@query
def raw_counts(spark, sf_dir):
    return worksheet.raw_counts(raw_tables(spark, sf_dir))


@query
def gps_last_7_days(spark, sf_dir):
    return worksheet.gps_events_per_day(raw_tables(spark, sf_dir)["gps_events"])


@query
def delivery_status_histogram(spark, sf_dir):
    return worksheet.delivery_status_histogram(raw_tables(spark, sf_dir)["delivery_events"])


@query
def driver_status_counts(spark, sf_dir):
    return worksheet.driver_status_counts(raw_tables(spark, sf_dir)["driver_events"])


@query
def load_audit_by_day(spark, sf_dir):
    return worksheet.rows_loaded_per_day(raw_tables(spark, sf_dir)["gps_events"])


# --- state, gauges, quality --------------------------------------------------


def lake(spark, sf_dir):
    """The lake's event types from the RAW tables."""
    raw = raw_tables(spark, sf_dir)
    return {t: raw[table] for t, table in RAW_TABLE_BY_EVENT_TYPE.items()}


def current_state(spark, sf_dir):
    return state.vehicle_state(positions_with_driver(spark, sf_dir))


def positions_with_driver(spark, sf_dir):
    return stage(spark, sf_dir, "stg_gps_events").withColumnsRenamed(
        {"latitude": "lat", "longitude": "lon"}
    )


@query
def vehicle_state(spark, sf_dir):
    return comparable(state.encode_state(current_state(spark, sf_dir)))


@query
def vehicle_state_decoded(spark, sf_dir):
    return state.decode_state(state.encode_state(current_state(spark, sf_dir)))


@query
def vehicle_lookup(spark, sf_dir):
    return comparable(state.lookup_vehicle(current_state(spark, sf_dir), "veh-3"))


@query
def live_vehicles(spark, sf_dir):
    """Tracked vehicles an hour before the newest position, with one hour to live."""
    found = current_state(spark, sf_dir)
    return state.tracked_vehicles(
        state.live_state(found, F.lit("2024-01-31 00:00:00").cast("timestamp"), 3600)
    )


@query
def fleet_speed(spark, sf_dir):
    return state.fleet_speed(current_state(spark, sf_dir)).withColumn(
        "avg_speed_kmh", F.round("avg_speed_kmh", 6)
    )


def all_lake_gauges(spark, sf_dir):
    return reduce(
        DataFrame.unionByName,
        [gauges.lake_gauges(t, rows, as_of()) for t, rows in lake(spark, sf_dir).items()],
    )


@query
def lake_event_counts(spark, sf_dir):
    return all_lake_gauges(spark, sf_dir).filter("metric = 'delivery_lake_events_total'")


@query
def lake_freshness(spark, sf_dir):
    return all_lake_gauges(spark, sf_dir).filter("metric = 'delivery_lake_last_event_age_seconds'")


@query
def drivers_by_status(spark, sf_dir):
    return gauges.driver_gauges(lake(spark, sf_dir)["driver"])


@query
def fleet_metrics(spark, sf_dir):
    rows = {
        EVENT_TYPE_BY_TOPIC[t]: clean(spark, sf_dir, t)
        for t in PARSE_NAMES.values()
        if t != GPS_TOPIC
    }
    # stored as a lake would be: each topic is parsed once for all gauges, positions before they are enriched
    positions = stored(spark, {"gps": clean(spark, sf_dir, GPS_TOPIC)}, "positions")["gps"]
    moved = ingest.with_lake_columns(enrich.enrich_gps(positions), "gps")
    tables = stored(spark, {"gps": moved, **rows}, "gauges")
    found = state.vehicle_state(tables["gps"])
    return gauges.fleet_metrics(tables, found, as_of()).withColumn("value", F.round("value", 6))


@query
def quality_results(spark, sf_dir):
    return quality.quality_results(lake(spark, sf_dir))


@query
def quality_score(spark, sf_dir):
    return quality.quality_score(quality.quality_results(lake(spark, sf_dir)))


@query
def table_tests(spark, sf_dir):
    raw = raw_tables(spark, sf_dir)
    staged = stored(spark, staging.staging_tables(raw), "tested")
    built = jobs.build_marts(staged, work_folder(spark, "tested-marts"))
    return quality.table_tests({**raw, **staged, **built})


# --- streams, files, jobs ----------------------------------------------------


@query
def stream_enriched(spark, sf_dir):
    return comparable(rounded(streams.stream_enriched(spark, sf_dir)))


@query
def stream_late(spark, sf_dir):
    return comparable(rounded(streams.stream_late(spark, sf_dir)))


@query
def stream_ordered(spark, sf_dir):
    return comparable(rounded(streams.stream_ordered(spark, sf_dir)))


for _name, _query in streams.STREAM_QUERIES.items():
    QUERIES[_name] = lambda spark, sf_dir, run=_query: comparable(run(spark, sf_dir))
