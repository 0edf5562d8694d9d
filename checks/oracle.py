"""The same results in DuckDB SQL, over the driver's ``events`` view."""

import re

from checks.fleet import PAYLOAD_SQL, RAW_SQL
from convoy.schemas import DELIVERY_TOPIC, DRIVER_TOPIC, GPS_TOPIC, ORDER_TOPIC

AS_OF = "TIMESTAMP '2024-03-01 00:00:00'"

# --- building blocks: named sub-queries --------------------------------------

CTE = {f"raw_{name}": text.replace("{events}", "events") for name, text in RAW_SQL.items()}

CTE["stg_gps_events"] = """
 SELECT vehicle_id, driver_id, latitude, longitude, speed_kmh, event_time, load_timestamp FROM (
  SELECT vehicle_id, driver_id, lat AS latitude, lon AS longitude, speed_kmh, event_time, load_timestamp,
   row_number() OVER (PARTITION BY vehicle_id, event_time ORDER BY load_timestamp DESC NULLS FIRST,
    driver_id DESC NULLS LAST, lat DESC NULLS LAST, lon DESC NULLS LAST, speed_kmh DESC NULLS LAST) AS rn
  FROM raw_gps_events
  WHERE vehicle_id IS NOT NULL AND event_time IS NOT NULL AND speed_kmh >= 0
   AND lat BETWEEN 45.0 AND 46.5 AND lon BETWEEN -74.5 AND -73.0) WHERE rn = 1"""
CTE["stg_delivery_events"] = """
 SELECT package_id, order_id, vehicle_id, driver_id, status, event_time, load_timestamp FROM (
  SELECT package_id, order_id, vehicle_id, driver_id, lower(trim(raw_status)) AS status, event_time, load_timestamp,
   row_number() OVER (PARTITION BY package_id, event_time ORDER BY load_timestamp DESC NULLS FIRST,
    order_id DESC NULLS LAST, vehicle_id DESC NULLS LAST, driver_id DESC NULLS LAST, raw_status DESC NULLS LAST) AS rn
  FROM (SELECT * EXCLUDE (status), status AS raw_status FROM raw_delivery_events)
  WHERE package_id IS NOT NULL AND order_id IS NOT NULL AND event_time IS NOT NULL
   AND raw_status IN ('picked_up', 'in_transit', 'delivered', 'failed')) WHERE rn = 1"""
CTE["stg_orders"] = """
 SELECT order_id, package_id, status, event_time, load_timestamp FROM (
  SELECT order_id, package_id, lower(trim(status)) AS status, event_time, load_timestamp,
   row_number() OVER (PARTITION BY order_id ORDER BY load_timestamp DESC NULLS FIRST,
    event_time DESC NULLS FIRST, package_id DESC NULLS LAST, lower(trim(status)) DESC NULLS LAST) AS rn
  FROM raw_orders
  WHERE order_id IS NOT NULL AND package_id IS NOT NULL AND event_time IS NOT NULL) WHERE rn = 1"""
CTE["stg_driver_events"] = """
 SELECT driver_id, vehicle_id, status, event_time, load_timestamp FROM (
  SELECT driver_id, vehicle_id, lower(trim(raw_status)) AS status, event_time, load_timestamp,
   row_number() OVER (PARTITION BY driver_id, event_time ORDER BY load_timestamp DESC NULLS FIRST,
    vehicle_id DESC NULLS LAST, raw_status DESC NULLS LAST) AS rn
  FROM (SELECT * EXCLUDE (status), status AS raw_status FROM raw_driver_events)
  WHERE driver_id IS NOT NULL AND event_time IS NOT NULL
   AND raw_status IN ('online', 'offline', 'on_break', 'delivering')) WHERE rn = 1"""


def _payload(topic):
    return PAYLOAD_SQL[topic].replace("{events}", "events")


def _parsed(topic, key, lost, fields):
    shown = ", ".join(
        f"CASE WHEN event_id % 37 = 0{' OR event_id % 31 = 0' if f == lost else ''} THEN NULL ELSE {f} END AS {f}"
        for f in fields
    )
    return f"""
 SELECT {key} AS kafka_key, ts AS kafka_timestamp, {shown},
  CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'x' WHEN event_id % 29 = 0 THEN 'not-a-date'
   ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS "timestamp",
  CASE WHEN event_id % 37 = 0 OR event_id % 31 = 0 OR event_id % 29 = 0 THEN NULL ELSE ts END AS event_time
 FROM ({_payload(topic)})"""


GPS_FIELDS = ["vehicle_id", "driver_id", "lat", "lon", "speed_kmh"]
DELIVERY_FIELDS = ["package_id", "order_id", "vehicle_id", "status", "lat", "lon"]
ORDER_FIELDS = ["order_id", "package_id", "dest_lat", "dest_lon", "status"]
DRIVER_FIELDS = ["driver_id", "vehicle_id", "status", "lat", "lon"]

CTE["parsed_gps"] = _parsed(GPS_TOPIC, "vehicle_id", "vehicle_id", GPS_FIELDS)
CTE["parsed_delivery"] = _parsed(DELIVERY_TOPIC, "package_id", "order_id", DELIVERY_FIELDS)
CTE["parsed_order"] = _parsed(ORDER_TOPIC, "package_id", "order_id", ORDER_FIELDS)
CTE["parsed_driver"] = _parsed(DRIVER_TOPIC, "driver_id", "vehicle_id", DRIVER_FIELDS)

VALID = {
    "gps": "vehicle_id IS NOT NULL AND driver_id IS NOT NULL",
    "delivery": "package_id IS NOT NULL AND order_id IS NOT NULL AND vehicle_id IS NOT NULL",
    "order": "order_id IS NOT NULL AND package_id IS NOT NULL",
    "driver": "driver_id IS NOT NULL AND vehicle_id IS NOT NULL",
}
TOPIC = {
    "gps": "gps_positions",
    "delivery": "delivery_events",
    "order": "orders",
    "driver": "driver_events",
}
IN_BOX = "(lat IS NULL OR lat BETWEEN 45.0 AND 46.5) AND (lon IS NULL OR lon BETWEEN -74.5 AND -73.0)"
for _t, _valid in VALID.items():
    _box = "" if _t == "order" else f" AND {IN_BOX}"
    _status = "" if _t == "gps" else " REPLACE (lower(trim(status)) AS status)"
    CTE[f"clean_{_t}"] = f"SELECT *{_status} FROM parsed_{_t} WHERE {_valid}{_box}"


def _moved(source, order):
    return f"""
 SELECT *, CASE WHEN computed_speed_kmh IS NULL THEN NULL ELSE computed_speed_kmh < 1.0 END AS is_immobile FROM (
  SELECT *, CASE WHEN elapsed_seconds > 0 THEN distance_km / elapsed_seconds * 3600.0 END AS computed_speed_kmh FROM (
   SELECT *, date_diff('second', prev_event_time, event_time) AS elapsed_seconds,
    6371.0 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS distance_km FROM (
    SELECT *, pow(sin(radians(lat - prev_lat) / 2), 2)
      + cos(radians(prev_lat)) * cos(radians(lat)) * pow(sin(radians(lon - prev_lon) / 2), 2) AS a FROM (
     SELECT *, CASE WHEN event_time IS NOT NULL THEN lag(lat) OVER w END AS prev_lat,
      CASE WHEN event_time IS NOT NULL THEN lag(lon) OVER w END AS prev_lon,
      CASE WHEN event_time IS NOT NULL THEN lag(event_time) OVER w END AS prev_event_time
     FROM {source}
     WINDOW w AS (PARTITION BY vehicle_id, event_time IS NULL ORDER BY {order})))))"""


FLAGS = """array_to_string(list_filter([
  CASE WHEN computed_speed_kmh > 130.0 THEN 'SPEED_TOO_HIGH' END,
  CASE WHEN abs(computed_speed_kmh - speed_kmh) > 50.0 THEN 'SPEED_MISMATCH' END,
  CASE WHEN is_immobile THEN 'IMMOBILE' END,
  CASE WHEN distance_km > 2.0 THEN 'GPS_JUMP' END], lambda x: x IS NOT NULL), ',')"""

CTE["stg_positions"] = """
 SELECT vehicle_id, latitude AS lat, longitude AS lon, speed_kmh, event_time FROM stg_gps_events"""
CTE["moved"] = _moved("stg_positions", "event_time")
_ORDER = ", ".join(
    f"{c} ASC NULLS FIRST"
    for c in ["event_time", "kafka_timestamp", "kafka_key", "driver_id", "lat", "lon", "speed_kmh", '"timestamp"']
)
CTE["lake_moved"] = _moved("clean_gps", _ORDER)
CTE["lake_gps"] = f"SELECT *, {FLAGS} AS anomaly_types FROM lake_moved"

CTE["hot_positions"] = """
 SELECT CASE WHEN vehicle_id LIKE 'veh-1%' THEN vehicle_id ELSE 'veh-hot' END AS vehicle_id, lat, lon, speed_kmh,
  CASE WHEN vehicle_id LIKE 'veh-1%' THEN event_time WHEN minute(event_time) < 40 THEN TIMESTAMP '2024-01-10 00:00:00'
   ELSE TIMESTAMP '2024-01-10 00:00:00' + to_seconds(60 * minute(event_time)) END AS event_time FROM stg_positions"""
CTE["hot_moved"] = _moved("hot_positions", "event_time, lat, lon, speed_kmh")
CTE["driver_history"] = """
 SELECT vehicle_id, event_time AS driver_assigned_at, max(driver_id) AS driver_id FROM stg_driver_events
 WHERE vehicle_id IS NOT NULL AND driver_id IS NOT NULL GROUP BY vehicle_id, event_time"""
CTE["asof_driver"] = """
 SELECT d.package_id, d.order_id, d.vehicle_id, d.status, d.event_time, h.driver_id
 FROM stg_delivery_events d ASOF LEFT JOIN driver_history h
  ON d.vehicle_id = h.vehicle_id AND d.event_time >= h.driver_assigned_at"""
CTE["delivery_pivot"] = """
 SELECT package_id, max(any_order) AS order_id, max(any_vehicle) AS vehicle_id, max(any_driver) AS driver_id,
  max(latest) FILTER (status = 'picked_up') AS picked_up_at, max(latest) FILTER (status = 'in_transit') AS in_transit_at,
  max(latest) FILTER (status = 'delivered') AS delivered_at, max(latest) FILTER (status = 'failed') AS failed_at
 FROM (SELECT package_id, status, max(event_time) AS latest, max(order_id) AS any_order,
   max(vehicle_id) AS any_vehicle, max(driver_id) AS any_driver FROM asof_driver GROUP BY package_id, status)
 GROUP BY package_id"""
_REACHED = ", ".join(
    f"CASE WHEN {status}_at IS NOT NULL THEN '{status}' END" for status in ("delivered", "failed", "in_transit", "picked_up")
)
_MINUTES = ", ".join(
    f"date_diff('minute', {begin}, {end}) AS {name}"
    for name, begin, end in [
        ("minutes_order_to_pickup", "order_created_at", "picked_up_at"),
        ("minutes_pickup_to_delivery", "picked_up_at", "delivered_at"),
        ("minutes_order_to_delivery", "order_created_at", "delivered_at"),
    ]
)
CTE["fct_deliveries"] = f"""
 SELECT package_id, order_id, vehicle_id, driver_id, order_created_at, picked_up_at, in_transit_at, delivered_at,
  failed_at, coalesce({_REACHED}, 'pending') AS final_status, {_MINUTES},
  NOT delivered_at IS NULL AS is_delivered, NOT failed_at IS NULL AS is_failed
 FROM delivery_pivot LEFT JOIN (SELECT order_id, event_time AS order_created_at FROM stg_orders) USING (order_id)"""
CTE["gps_daily"] = """
 SELECT day AS activity_date, count(DISTINCT vehicle_id) AS n_active_vehicles,
  count(DISTINCT driver_id) AS n_active_drivers, round(avg(speed_kmh), 2) AS fleet_avg_speed_kmh,
  count(*) AS n_gps_points
 FROM (SELECT vehicle_id, driver_id, speed_kmh, CAST(event_time AS DATE) AS day FROM stg_gps_events) GROUP BY day"""
CTE["delivery_daily"] = """
 SELECT day AS activity_date, count(*) AS n_deliveries_touched,
  count(*) FILTER (list_contains(seen, 'delivered')) AS n_delivered,
  count(*) FILTER (list_contains(seen, 'failed')) AS n_failed,
  count(*) FILTER (list_contains(seen, 'picked_up')) AS n_picked_up
 FROM (SELECT CAST(event_time AS DATE) AS day, package_id, list(DISTINCT status) AS seen
  FROM stg_delivery_events GROUP BY 1, 2) GROUP BY day"""


def _share(good, bad):
    """Percentage of good ones, null without any."""
    return f"round(CAST(100.0 AS DOUBLE) * {good} / nullif({good} + {bad}, 0), 2)"


CTE["fct_daily_activity"] = f"""
 SELECT activity_date, {", ".join(f"coalesce({c}, 0) AS {c}" for c in ("n_active_vehicles", "n_active_drivers"))},
  fleet_avg_speed_kmh, {", ".join(
      f"coalesce({c}, 0) AS {c}"
      for c in ("n_gps_points", "n_deliveries_touched", "n_delivered", "n_failed", "n_picked_up"))},
  {_share("n_delivered", "n_failed")} AS daily_success_rate_pct
 FROM (SELECT activity_date FROM gps_daily UNION SELECT activity_date FROM delivery_daily)
  LEFT JOIN gps_daily USING (activity_date) LEFT JOIN delivery_daily USING (activity_date)"""
CTE["dim_vehicles"] = """
 SELECT vehicle_id, count(DISTINCT activity_date) AS n_active_days, min(activity_date) AS first_active_date,
  max(activity_date) AS last_active_date, CAST(sum(n_gps_points) AS BIGINT) AS total_gps_points,
  round(avg(avg_speed_kmh), 2) AS avg_speed_kmh_overall, max(max_speed_kmh) AS max_speed_ever_kmh,
  max(n_distinct_drivers) AS max_drivers_per_day
 FROM (SELECT vehicle_id, CAST(event_time AS DATE) AS activity_date, count(*) AS n_gps_points,
   avg(speed_kmh) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh, count(DISTINCT driver_id) AS n_distinct_drivers
  FROM stg_gps_events WHERE speed_kmh IS NOT NULL GROUP BY 1, 2) GROUP BY vehicle_id"""


def _dim_drivers(steps):
    return f"""
 SELECT driver_id, newest.vehicle AS current_vehicle_id, newest.status AS current_status,
  newest.at AS last_status_change, first_seen_at, last_seen_at,
  date_diff('hour', first_seen_at, last_seen_at) AS active_hours, total_status_changes,
  coalesce(done, 0) AS n_deliveries_completed, coalesce(lost, 0) AS n_deliveries_failed,
  {_share("done", "lost")} AS success_rate_pct
 FROM (SELECT driver_id, count(*) AS total_status_changes, min(event_time) AS first_seen_at,
   max(event_time) AS last_seen_at,
   arg_max({{'vehicle': vehicle_id, 'status': status, 'at': event_time}}, event_time) AS newest
  FROM stg_driver_events GROUP BY driver_id)
 LEFT JOIN (SELECT driver_id, count(*) FILTER (list_contains(seen, 'delivered')) AS done,
   count(*) FILTER (list_contains(seen, 'failed')) AS lost
  FROM (SELECT driver_id, package_id, list(DISTINCT status) AS seen FROM {steps}
   WHERE driver_id IS NOT NULL GROUP BY driver_id, package_id) GROUP BY driver_id) USING (driver_id)"""


CTE["dim_drivers"] = _dim_drivers("stg_delivery_events")
CTE["dim_drivers_resolved"] = _dim_drivers("asof_driver")
CTE["dim_date"] = f"""
 SELECT date_day, CAST(year(date_day) AS INTEGER) AS "year", CAST(quarter(date_day) AS INTEGER) AS quarter,
  CAST(month(date_day) AS INTEGER) AS "month", CAST(day(date_day) AS INTEGER) AS day_of_month,
  CAST(dayofweek(date_day) AS INTEGER) AS day_of_week_num, strftime(date_day, '%a') AS day_of_week_name,
  strftime(date_day, '%b') AS month_name, CAST(weekofyear(date_day) AS INTEGER) AS week_of_year,
  dayofweek(date_day) IN (0, 6) AS is_weekend, dayofweek(date_day) NOT IN (0, 6) AS is_business_day,
  CAST(date_day - CAST({AS_OF} AS DATE) AS INTEGER) AS days_from_today,
  CAST(date_trunc('month', date_day) AS DATE) AS month_start, last_day(date_day) AS month_end,
  CAST(date_trunc('quarter', date_day) AS DATE) AS quarter_start, CAST(date_trunc('year', date_day) AS DATE) AS year_start
 FROM (SELECT CAST(start_date + CAST(n AS INTEGER) AS DATE) AS date_day, end_date
  FROM (SELECT min(activity_date) - 30 AS start_date, max(activity_date) + 30 AS end_date FROM fct_daily_activity),
   range(40000) AS days(n)) WHERE date_day <= end_date"""
CTE["stretched_activity"] = """
 SELECT CAST(DATE '2024-01-01' + CAST(20 * (activity_date - DATE '2024-01-01') AS INTEGER) AS DATE) AS activity_date
 FROM fct_daily_activity"""
CTE["dim_date_long"] = CTE["dim_date"].replace("fct_daily_activity", "stretched_activity")
CTE["vehicle_latest"] = """
 SELECT vehicle_id, driver_id, latitude AS lat, longitude AS lon, speed_kmh, event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_time DESC NULLS LAST) AS rn
  FROM stg_gps_events) WHERE rn = 1"""

# Every check of the quality suites: event type, expectation, column, condition for a bad row.
_CHECKS = []
for _t, _table, _keys in [
    ("gps", "raw_gps_events", ["vehicle_id", "driver_id"]),
    ("delivery", "raw_delivery_events", ["package_id", "order_id", "vehicle_id"]),
    ("order", "raw_orders", ["order_id", "package_id"]),
    ("driver", "raw_driver_events", ["driver_id", "vehicle_id"]),
]:
    _CHECKS += [(_t, _table, "not_null", k, f"{k} IS NULL") for k in _keys]
_CHECKS += [
    ("gps", "raw_gps_events", "between", "lat", "lat < 45.0 OR lat > 46.5"),
    ("gps", "raw_gps_events", "between", "lon", "lon < -74.5 OR lon > -73.0"),
    ("gps", "raw_gps_events", "between", "speed_kmh", "speed_kmh < 0"),
    ("delivery", "raw_delivery_events", "in_set", "status",
     "status NOT IN ('created', 'picked_up', 'in_transit', 'delivered', 'failed')"),
    ("order", "raw_orders", "in_set", "status", "status NOT IN ('created')"),
    ("driver", "raw_driver_events", "in_set", "status",
     "status NOT IN ('offline', 'online', 'on_break', 'delivering')"),
]


def _quality(tables):
    return " UNION ALL ".join(
        f"SELECT '{t}' AS event_type, '{kind}' AS expectation, '{col}' AS \"column\","
        f" count(*) FILTER ({bad}) = 0 AS success, count(*) FILTER ({bad}) AS n_unexpected, count(*) AS n_rows"
        f" FROM {tables[t]}"
        for t, _, kind, col, bad in _CHECKS
    )


CTE["quality_results"] = _quality({t: table for t, table, *_ in _CHECKS})


def _scores(results):
    return f"""
 SELECT scope, count(event_type) AS n_expectations, count(*) FILTER (success) AS n_success,
  CASE WHEN count(event_type) = 0 THEN 0.0e0
   WHEN scope = 'all' THEN round(100.0e0 * count(*) FILTER (success) / count(event_type), 1)
   ELSE 100.0e0 * count(*) FILTER (success) / count(event_type) END AS quality_score,
  count(event_type) > 0 AND count(*) FILTER (success) = count(event_type) AS all_passed
 FROM (VALUES ('gps'), ('delivery'), ('order'), ('driver'), ('all')) s(scope)
 LEFT JOIN {results} q ON s.scope = 'all' OR q.event_type = s.scope GROUP BY scope"""


CTE["quality_score"] = _scores("quality_results")
CTE["lake_quality"] = _quality({"gps": "lake_gps", "delivery": "clean_delivery", "order": "clean_order", "driver": "clean_driver"})
CTE["lake_scores"] = _scores("lake_quality")


def with_ctes(text: str) -> str:
    """Prefix the building blocks a text reads from, dependencies first."""
    needed: list[str] = []

    def visit(part):
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", part):
            if name in CTE and name not in needed:
                visit(CTE[name])
                needed.append(name)

    visit(text)
    ctes = ",\n".join(f"{name} AS ({CTE[name]})" for name in needed)
    return f"WITH {ctes}\n{text}" if ctes else text


def _all(name):
    return f"SELECT * FROM {name}"


def _parsed_columns(fields):
    return f'kafka_key, kafka_timestamp, {", ".join(fields)}, "timestamp"'


_FIELDS = {"gps": GPS_FIELDS, "delivery": DELIVERY_FIELDS, "order": ORDER_FIELDS, "driver": DRIVER_FIELDS}
_TYPES = list(VALID)


def _union(texts):
    return " UNION ALL ".join(texts)


def _rejection_reason(t):
    keys = [p.split(" ")[0] for p in VALID[t].split(" AND ")]
    missing = ", ".join(f"CASE WHEN {k} IS NULL THEN '{k}' END" for k in keys)
    outside = "" if t == "order" else f" WHEN NOT ({IN_BOX}) THEN 'outside service area'"
    return f"CASE WHEN NOT ({VALID[t]}) THEN 'missing ' || concat_ws(',', {missing}){outside} END"


_LAKE_TABLES = {
    "gps": "raw_gps_events", "delivery": "raw_delivery_events",
    "order": "raw_orders", "driver": "raw_driver_events",
}
_ANOMALIES = ["SPEED_TOO_HIGH", "SPEED_MISMATCH", "IMMOBILE", "GPS_JUMP"]
_DRIVER_STATUSES = ["offline", "online", "on_break", "delivering"]
_MOVED = """prev_lat, prev_lon, prev_event_time, round(distance_km, 6) AS distance_km, elapsed_seconds,
 round(computed_speed_kmh, 6) AS computed_speed_kmh, is_immobile"""


def _events_total(tables):
    return _union(
        f"SELECT 'delivery_lake_events_total' AS metric, '{t}' AS label, CAST(count(*) AS DOUBLE) AS value FROM {tables[t]}"
        for t in _TYPES
    )


def _freshness(tables):
    return _union(
        f"SELECT 'delivery_lake_last_event_age_seconds' AS metric, '{t}' AS label,"
        f" coalesce((epoch_us({AS_OF}) - epoch_us(max(event_time))) / 1000000, -1.0e0) AS value FROM {tables[t]}"
        for t in _TYPES
    )


def _anomalies(table):
    return _union(
        f"SELECT 'delivery_lake_anomalies_total' AS metric, '{a}' AS label,"
        f" CAST(count(*) FILTER (contains(anomaly_types, '{a}')) AS DOUBLE) AS value FROM {table}"
        for a in _ANOMALIES
    )


def _drivers(table):
    return f"""SELECT 'delivery_drivers_by_status' AS metric, s.label, CAST(count(l.driver_id) AS DOUBLE) AS value
 FROM (VALUES {", ".join(f"('{s}')" for s in _DRIVER_STATUSES)}) s(label)
 LEFT JOIN (SELECT driver_id, status FROM (
   SELECT driver_id, status, row_number() OVER (PARTITION BY driver_id ORDER BY event_time DESC, status DESC) AS rn
   FROM {table} WHERE driver_id IS NOT NULL AND event_time IS NOT NULL) WHERE rn = 1) l ON l.status = s.label
 GROUP BY s.label"""


_CLEAN_TABLES = {"gps": "lake_gps", "delivery": "clean_delivery", "order": "clean_order", "driver": "clean_driver"}
_CLEAN_STATE = """(SELECT vehicle_id, speed_kmh, row_number() OVER (PARTITION BY vehicle_id
 ORDER BY event_time DESC NULLS LAST, driver_id DESC, lat DESC, lon DESC, speed_kmh DESC) AS rn FROM clean_gps )"""

_TESTS = []
for _table, _columns in {
    "gps_events": ["vehicle_id", "driver_id", "event_time"],
    "delivery_events": ["package_id", "order_id", "event_time"],
    "orders": ["order_id", "package_id", "event_time"],
    "driver_events": ["driver_id", "event_time"],
    "stg_gps_events": ["vehicle_id", "driver_id", "event_time"],
    "stg_delivery_events": ["package_id", "order_id", "status", "event_time"],
    "stg_orders": ["order_id", "package_id", "event_time"],
    "stg_driver_events": ["driver_id", "status", "event_time"],
    "dim_drivers": ["driver_id", "current_status"],
    "dim_vehicles": ["vehicle_id"],
    "dim_date": ["date_day"],
    "fct_deliveries": ["package_id", "final_status"],
    "fct_daily_activity": ["activity_date"],
}.items():
    _source = _table if _table.startswith(("stg_", "dim_", "fct_")) else f"raw_{_table}"
    _TESTS += [(_table, _source, "not_null", c, f"FROM {_source} WHERE {c} IS NULL") for c in _columns]
for _table, _column in [
    ("stg_orders", "order_id"), ("dim_drivers", "driver_id"), ("dim_vehicles", "vehicle_id"),
    ("dim_date", "date_day"), ("fct_deliveries", "package_id"), ("fct_daily_activity", "activity_date"),
]:
    _TESTS.append((_table, _table, "unique", _column,
                   f"FROM (SELECT {_column} FROM {_table} WHERE {_column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"))
for _table, _column, _words in [
    ("stg_delivery_events", "status", "'picked_up', 'in_transit', 'delivered', 'failed'"),
    ("stg_driver_events", "status", "'online', 'offline', 'on_break', 'delivering'"),
    ("dim_drivers", "current_status", "'online', 'offline', 'on_break', 'delivering'"),
    ("fct_deliveries", "final_status", "'delivered', 'failed', 'in_transit', 'picked_up', 'pending'"),
]:
    _TESTS.append((_table, _table, "in_set", _column, f"FROM {_table} WHERE {_column} NOT IN ({_words})"))

_STATE_TEXT = """SELECT 'vehicle:' || vehicle_id || ':state' AS key, coalesce(driver_id, '') AS driver_id,
 coalesce(CAST(lat AS VARCHAR), '') AS lat, coalesce(CAST(lon AS VARCHAR), '') AS lon,
 coalesce(CAST(speed_kmh AS VARCHAR), '') AS speed_kmh, {iso} AS event_time FROM vehicle_latest"""
_ISO = """strftime(event_time, '%Y-%m-%dT%H:%M:%S')
 || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN '' ELSE strftime(event_time, '.%f') END"""

# --- the queries -------------------------------------------------------------

_TEXTS = {
    "parse_events_gps": f"SELECT {_parsed_columns(GPS_FIELDS)} FROM parsed_gps",
    "parse_events_delivery": f"SELECT {_parsed_columns(DELIVERY_FIELDS)} FROM parsed_delivery",
    "parse_events_orders": f"SELECT {_parsed_columns(ORDER_FIELDS)} FROM parsed_order",
    "parse_events_driver": f"SELECT {_parsed_columns(DRIVER_FIELDS)} FROM parsed_driver",
    "validity_counts": _union(
        f"SELECT '{TOPIC[t]}' AS topic, {VALID[t]} AS is_valid, count(*) AS n FROM parsed_{t} GROUP BY 2"
        for t in _TYPES
    ),
    "valid_split": f"SELECT {_parsed_columns(DELIVERY_FIELDS)} FROM parsed_delivery WHERE {VALID['delivery']}",
    "dead_letter": _union(
        f"SELECT '{TOPIC[t]}' AS reject_topic, 'missing_required_key' AS reject_reason,"
        f" CAST({AS_OF} AS DATE) AS reject_date, kafka_key, kafka_timestamp"
        f" FROM parsed_{t} WHERE NOT ({VALID[t]})"
        for t in _TYPES
    ),
    "rejected_by_reason": "SELECT topic, reason, count(*) AS n FROM ("
    + _union(f"SELECT '{TOPIC[t]}' AS topic, {_rejection_reason(t)} AS reason FROM parsed_{t}" for t in _TYPES)
    + ") WHERE reason IS NOT NULL GROUP BY 1, 2",
    "clean_events": f"SELECT {_parsed_columns(DELIVERY_FIELDS)}, event_time FROM clean_delivery",
    "valid_gps": f"SELECT {_parsed_columns(GPS_FIELDS)} FROM parsed_gps WHERE {VALID['gps']}",
    "valid_orders": f"SELECT {_parsed_columns(ORDER_FIELDS)} FROM parsed_order WHERE {VALID['order']}",
    "valid_driver": f"SELECT {_parsed_columns(DRIVER_FIELDS)} FROM parsed_driver WHERE {VALID['driver']}",
    "clean_orders": f"SELECT {_parsed_columns(ORDER_FIELDS)}, event_time FROM clean_order",
    "clean_driver": f"SELECT {_parsed_columns(DRIVER_FIELDS)}, event_time FROM clean_driver",
    "clean_gps": f"SELECT {_parsed_columns(GPS_FIELDS)}, event_time FROM clean_gps",
    "movement_metrics": f"SELECT vehicle_id, lat, lon, speed_kmh, event_time, {_MOVED} FROM moved",
    "movement_metrics_hot": f"SELECT vehicle_id, lat, lon, speed_kmh, event_time, {_MOVED} FROM hot_moved",
    "dim_date_long": _all("dim_date_long"),
    "anomaly_flags": f"SELECT vehicle_id, event_time, anomaly_types, anomaly_types <> '' AS is_anomaly"
    f" FROM (SELECT *, {FLAGS} AS anomaly_types FROM moved )",
    "gps_enriched": f"SELECT {_parsed_columns(GPS_FIELDS)}, event_time, {_MOVED}, anomaly_types,"
    " anomaly_types <> '' AS is_anomaly, 'gps' AS event_type, CAST(event_time AS DATE) AS event_date FROM lake_gps",
    "anomaly_counts": _anomalies("lake_gps"),
    **{n: _all(n) for n in ["stg_gps_events", "stg_delivery_events", "stg_orders", "stg_driver_events"]},
    **{
        n: _all(n)
        for n in [
            "asof_driver", "delivery_pivot", "fct_deliveries", "gps_daily", "delivery_daily",
            "fct_daily_activity", "dim_vehicles", "dim_drivers", "dim_drivers_resolved", "dim_date",
            "quality_results", "quality_score",
        ]
    },
    "kpi_cards": """SELECT (SELECT count(*) FROM fct_deliveries ) AS total_deliveries,
 (SELECT round(100.0e0 * count(*) FILTER (is_delivered) / count(*) FILTER (is_delivered OR is_failed), 2)
  FROM fct_deliveries ) AS success_rate_pct,
 (SELECT count(*) FROM dim_vehicles ) AS active_vehicles, (SELECT count(*) FROM dim_drivers ) AS active_drivers,
 (SELECT count(*) FROM fct_daily_activity ) AS activity_days""",
    "raw_counts": _union(
        f"SELECT '{n}' AS event_type, count(*) AS n_rows FROM raw_{n.lower()}"
        for n in ["GPS_EVENTS", "DELIVERY_EVENTS", "ORDERS", "DRIVER_EVENTS"]
    ),
    "gps_last_7_days": """SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n_events
 FROM raw_gps_events GROUP BY 1 ORDER BY 1 DESC NULLS FIRST LIMIT 7""",
    "delivery_status_histogram": "SELECT status, count(*) AS n FROM raw_delivery_events GROUP BY status",
    "driver_status_counts": """SELECT status, count(*) AS n_drivers FROM (SELECT status, row_number() OVER (
  PARTITION BY driver_id ORDER BY event_time DESC NULLS FIRST, status DESC) AS rn FROM raw_driver_events )
 WHERE rn = 1 GROUP BY status""",
    "load_audit_by_day": """SELECT CAST(load_timestamp AS DATE) AS load_date, count(*) AS n_rows_loaded
 FROM raw_gps_events GROUP BY 1""",
    "vehicle_state": _STATE_TEXT.format(iso=_ISO),
    "vehicle_state_decoded": f"""SELECT vehicle_id, driver_id, lat, lon, speed_kmh, {_ISO} AS event_time
 FROM vehicle_latest""",
    "vehicle_lookup": """SELECT vehicle_id, driver_id, lat, lon, speed_kmh, event_time, event_time AS updated_at
 FROM vehicle_latest WHERE vehicle_id = 'veh-3'""",
    "live_vehicles": """SELECT vehicle_id FROM vehicle_latest
 WHERE epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(event_time) < 3600000000""",
    "fleet_speed": """SELECT count(*) AS vehicles_tracked, round(coalesce(avg(speed_kmh), 0.0e0), 6) AS avg_speed_kmh
 FROM vehicle_latest""",
    "lake_event_counts": _events_total(_LAKE_TABLES),
    "lake_freshness": _freshness(_LAKE_TABLES),
    "drivers_by_status": _drivers("raw_driver_events"),
    "fleet_metrics": "SELECT metric, label, round(value, 6) AS value FROM ("
    + _union(
        [
            _events_total(_CLEAN_TABLES),
            _freshness(_CLEAN_TABLES),
            _anomalies("lake_gps"),
            _drivers("clean_driver"),
            f"SELECT 'delivery_vehicles_tracked', NULL, CAST(count(*) AS DOUBLE) FROM {_CLEAN_STATE} WHERE rn = 1",
            f"SELECT 'delivery_vehicles_avg_speed_kmh', NULL, coalesce(avg(speed_kmh), 0.0e0) FROM {_CLEAN_STATE} WHERE rn = 1",
            "SELECT 'delivery_data_quality_score', NULL, quality_score FROM lake_scores WHERE scope = 'all'",
            "SELECT 'delivery_data_quality_expectations_total', NULL, CAST(n_expectations AS DOUBLE) FROM lake_scores WHERE scope = 'all'",
            "SELECT 'delivery_data_quality_expectations_passed', NULL, CAST(n_success AS DOUBLE) FROM lake_scores WHERE scope = 'all'",
            "SELECT 'delivery_data_quality_score_by_type', scope, quality_score FROM lake_scores WHERE scope <> 'all'",
        ]
    )
    + ")",
    "table_tests": _union(
        f"SELECT '{table}' AS table_name, '{test}' AS test, '{column}' AS \"column\", count(*) AS n_failing,"
        f" count(*) = 0 AS success {rows}"
        for table, _, test, column, rows in _TESTS
    ),
}



def _loaded(t, table):
    return f"""SELECT '{table}' AS table_name, count(*) FILTER (kafka_timestamp >= middle) AS n_loaded,
 CAST(0 AS BIGINT) AS n_empty, CAST(0 AS BIGINT) AS n_errors, count(*) AS n_rows_after FROM clean_{t} ,
 (SELECT min(kafka_timestamp) + (max(kafka_timestamp) - min(kafka_timestamp)) / 2 AS middle FROM clean_{t} )"""


_LAKE_GPS = f"""SELECT {_parsed_columns(GPS_FIELDS)}, event_time, {_MOVED}, {FLAGS} AS anomaly_types,
 {FLAGS} <> '' AS is_anomaly, 'gps' AS event_type, CAST(event_time AS DATE) AS event_date FROM"""

_TEXTS |= {
    "stream_enriched": f"{_LAKE_GPS} lake_moved",
    "stream_late": f"{_LAKE_GPS} lake_moved",
    "stream_ordered": f"{_LAKE_GPS} lake_moved",
    "stream_lake": f"""SELECT {_parsed_columns(DELIVERY_FIELDS)}, event_time,
 'delivery' AS event_type, CAST(event_time AS DATE) AS event_date FROM clean_delivery""",
    "stream_dual_write": _union(
        f"SELECT CAST({i} AS INTEGER) AS lake, count(*) AS n FROM clean_order" for i in (0, 1)
    ),
    "stream_dedup": "SELECT package_id, event_time, status FROM clean_delivery",
    "stream_first_arrivals": "SELECT package_id, event_time, status FROM clean_delivery",
    "stream_two_writers": _union(
        f"""SELECT {_parsed_columns(DELIVERY_FIELDS)}, event_time, 'delivery' AS event_type,
 CAST(event_time AS DATE) AS event_date FROM clean_delivery"""
        for _ in range(2)
    ),
    "reloaded_empty": _union(
        f"SELECT CAST({i} AS INTEGER) AS step, count(*) AS n_rows FROM clean_order{' WHERE false' if i == 1 else ''}"
        for i in range(3)
    ),
    "lake_inventory": _union(
        f"""SELECT '{t}' AS event_type, count(DISTINCT coalesce(CAST(CAST(event_time AS DATE) AS VARCHAR), 'none'))
 AS n_files, true AS has_bytes FROM clean_{t}"""
        for t in _TYPES
    ),
    "batch_tables": _union(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}"
        for n in [
            "stg_gps_events", "stg_delivery_events", "stg_orders", "stg_driver_events", "dim_drivers",
            "dim_vehicles", "fct_deliveries", "fct_daily_activity", "dim_date",
        ]
    ),
    "stream_batches": _union(
        f"""SELECT '{q}' AS query_name, batch_id, count(*) AS n_input_rows FROM (
 SELECT CAST(CAST(t >= first + step AS INTEGER) + CAST(t >= first + 2 * step AS INTEGER) AS BIGINT) AS batch_id
 FROM (SELECT epoch_us(ts) AS t FROM events),
  (SELECT min(epoch_us(ts)) AS first, round((max(epoch_us(ts)) - min(epoch_us(ts))) / 3.0) AS step FROM events))
 GROUP BY batch_id"""
        for q in ("lake_orders", "lake_drivers")
    ),
    "stream_dual_rows": _union(
        f"""SELECT {_parsed_columns(ORDER_FIELDS)}, event_time, 'order' AS event_type,
 CAST(event_time AS DATE) AS event_date, {i} AS lake FROM clean_order"""
        for i in range(2)
    ),
    "stream_dead_letter": f"""SELECT kafka_key, kafka_timestamp, 'delivery_events' AS reject_topic,
 'missing_required_key' AS reject_reason, package_id, order_id FROM parsed_delivery WHERE NOT ({VALID['delivery']})""",
    "stream_state": """SELECT vehicle_id, driver_id, lat, lon, speed_kmh, event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY event_time DESC NULLS LAST, driver_id DESC NULLS LAST,
   lat DESC NULLS LAST, lon DESC NULLS LAST, speed_kmh DESC NULLS LAST) AS rn FROM clean_gps ) WHERE rn = 1""",
    "stream_topics": _union(
        f"""SELECT '{t}' AS event_type, (SELECT count(*) FROM clean_{t} ) AS n_lake,
 (SELECT count(*) FROM parsed_{t} WHERE NOT ({VALID[t]})) AS n_rejected"""
        for t in _TYPES
    ),
    "stream_progress": _union(
        f"SELECT '{q}' AS query_name, count(*) AS n_input_rows FROM events" for q in ("lake_orders", "lake_drivers")
    ),
    "incremental_load": _union(
        _loaded(t, table)
        for t, table in [
            ("gps", "gps_events"), ("delivery", "delivery_events"), ("order", "orders"), ("driver", "driver_events"),
        ]
    ),
    "load_outcomes": """SELECT CAST(step AS INTEGER) AS step, 'orders' AS table_name,
  CASE step WHEN 0 THEN early_files WHEN 1 THEN late_files ELSE 0 END AS n_files,
  CASE step WHEN 0 THEN early WHEN 1 THEN late ELSE 0 END AS n_loaded,
  CAST(0 AS BIGINT) AS n_empty, CAST(least(step, 1) AS BIGINT) AS n_errors,
  CASE step WHEN 0 THEN early ELSE early + late END AS n_rows_after
 FROM (SELECT unnest([0, 1, 2]) AS step),
  (SELECT count(*) FILTER (kafka_timestamp < middle) AS early, count(*) FILTER (kafka_timestamp >= middle) AS late,
    count(DISTINCT day) FILTER (kafka_timestamp < middle) AS early_files,
    count(DISTINCT day) FILTER (kafka_timestamp >= middle) AS late_files
   FROM (SELECT kafka_timestamp, coalesce(CAST(event_time AS DATE), DATE '0001-01-01') AS day FROM clean_order),
    (SELECT min(kafka_timestamp) + (max(kafka_timestamp) - min(kafka_timestamp)) / 2 AS middle FROM clean_order))""",
    "loaded_gps": "SELECT vehicle_id, driver_id, lat, lon, speed_kmh, event_time FROM clean_gps",
    "reloaded_orders": "SELECT order_id, package_id, status, event_time FROM clean_order",
    "batch_job": _all("fct_daily_activity"),
    "refreshed_deliveries": _all("fct_deliveries"),
    "refreshed_activity": _all("fct_daily_activity"),
}

ORACLE = {name: with_ctes(text) for name, text in _TEXTS.items()}
