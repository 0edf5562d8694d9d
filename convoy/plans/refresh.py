"""The two facts kept up to date by what a load has changed, instead of being built anew.

A refresh looks at the load batches that came since the last one. Their events name the days of
``fct_daily_activity`` and the packages of ``fct_deliveries`` that can differ now; only these are computed, and only
the days they lie in are written, as a *run*. One small file then says which run holds each day of both tables, and
which batches are in: readers see both tables before or after a refresh, and days that nothing
touched keep their files. A full reload of RAW (a new generation) builds everything anew.
"""

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from convoy.plans import marts as M
from convoy.plans import staging as S
from convoy.plans.jobs import gate
from convoy.schemas import RAW_SCHEMAS
from convoy.session import work_folder
from convoy.sources.lake import committed_numbers, file_exists, folder_values, read_parquet_or_empty, write_file
from convoy.sources.load import generation_of

#: The tables with the column their folders are named by.
FACTS = {"fct_daily_activity": "activity_date", "fct_deliveries": "delivery_day"}


def _versions_path(out: str) -> str:
    return f"{out.rstrip('/')}/versions"


def read_version(spark: SparkSession, out: str) -> dict:
    """What the newest refresh left: ``seen`` (generation and batch per RAW table) and ``days`` (run per day and table)."""
    versions = sorted(int(v) for v in folder_values(spark, _versions_path(out), "version"))
    if not versions:
        return {"version": 0, "seen": {}, "days": {name: {} for name in FACTS}}
    text = spark.read.text(f"{_versions_path(out)}/version={versions[-1]}", wholetext=True).first()[0]
    return {"version": versions[-1], **json.loads(text)}


def read_fact(spark: SparkSession, out: str, name: str, at: dict | None = None) -> DataFrame | None:
    """One of the facts as the newest refresh left it; None before the first."""
    days = (at or read_version(spark, out))["days"][name]
    rows = None
    for run in sorted(set(days.values())):
        own = spark.read.parquet(f"{out}/{name}/run={run}").withColumn(FACTS[name], F.col(FACTS[name]).cast("date"))
        own = own.filter(F.col(FACTS[name]).isin([date.fromisoformat(d) for d, r in days.items() if r == run]))
        rows = own if rows is None else rows.unionByName(own)
    return rows


def raw_batches(spark: SparkSession, raw: str, table: str, generation: int) -> DataFrame:
    """RAW rows with the number of the load batch that brought them."""
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField("load_batch", T.IntegerType())])
    return read_parquet_or_empty(spark, f"{raw}/{table}/generation={generation}", schema)


def _on(rows: DataFrame, days: list[date]) -> DataFrame:
    """Rows of some days; the bounds reach the Parquet scan."""
    first, last = F.lit(min(days)).cast("timestamp"), F.lit(max(days) + timedelta(days=1)).cast("timestamp")
    inside = (F.col("event_time") >= first) & (F.col("event_time") < last)
    return rows.filter(inside & F.to_date("event_time").isin(days))


def _days(rows: DataFrame, day) -> list[date]:
    """Different days, which are few however many the rows."""
    return [r[0] for r in rows.select(day.alias("day")).filter("day is not null").distinct().collect()]


def _kept(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows that are used several times, written once."""
    path = work_folder(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def touched_packages(raw: dict[str, DataFrame], changed: dict[str, DataFrame]) -> DataFrame:
    """Packages whose row can have changed: by their own events, their order, or a driver who took their vehicle
    before one of their events."""
    steps = raw["delivery_events"].filter("package_id is not null")
    own = changed["delivery_events"].select("package_id")
    of_orders = steps.join(changed["orders"].select("order_id").distinct(), "order_id", "left_semi").select("package_id")
    # a driver event that is loaded again may have moved from one vehicle to another: both count
    again = changed["driver_events"].select("driver_id", "event_time")
    span = again.agg(F.unix_micros(F.min("event_time")), F.unix_micros(F.max("event_time"))).first()
    near = F.col("event_time").between(*[F.timestamp_micros(F.lit(t).cast("long")) for t in span])
    moves = raw["driver_events"].filter(near).join(again.distinct(), ["driver_id", "event_time"], "left_semi")
    since = moves.groupBy("vehicle_id").agg(F.min("event_time").alias("since"))
    of_drivers = steps.join(since, "vehicle_id").filter("event_time >= since").select("package_id")
    found = own.unionByName(of_orders).unionByName(of_drivers)
    return found.filter("package_id is not null").distinct()


def deliveries_of(raw: dict[str, DataFrame], packages: DataFrame | None = None) -> DataFrame:
    """The delivery fact of some packages, or all, with the day of the first step.

    Steps and drivers are staged once and stored, because the as-of join reads them several times.
    """
    steps, orders = raw["delivery_events"], raw["orders"]
    drivers = S.stg_driver_events(raw["driver_events"])
    if packages is not None:
        steps = steps.join(packages, "package_id", "left_semi")
    steps = _kept(S.stg_delivery_events(steps), "staged-steps")
    if packages is not None:
        orders = orders.join(steps.select("order_id").distinct(), "order_id", "left_semi")
        # drivers' events are deduplicated before vehicles are picked: the newest load of one may have moved it
        drivers = drivers.join(steps.select("vehicle_id").distinct(), "vehicle_id", "left_semi")
    fact = M.fct_deliveries(steps, S.stg_orders(orders), _kept(drivers, "staged-drivers"))
    first = F.least("picked_up_at", "in_transit_at", "delivered_at", "failed_at")
    return fact.withColumn("delivery_day", F.to_date(first))


def _write_days(rows: DataFrame, out: str, name: str) -> dict[str, str]:
    """Write rows as a run; the run by day."""
    run = uuid.uuid4().hex[:12]
    path = f"{out}/{name}/run={run}"
    rows.hint("rebalance", FACTS[name]).write.partitionBy(FACTS[name]).parquet(path)
    return {day: run for day in folder_values(rows.sparkSession, path, FACTS[name])}


def refresh_facts(spark: SparkSession, raw: str, out: str, tested: bool = True) -> dict[str, list[str]]:
    """Bring both facts up to date with RAW; returns the days written, by table.

    With ``tested`` the table tests of the written days must pass, or nothing changes for readers.
    """
    at = read_version(spark, out)
    now = {}
    for table in RAW_SCHEMAS:
        generation = generation_of(spark, raw, table)
        batches = committed_numbers(spark, f"{raw}/{table}/generation={generation}", "load_batch")
        now[table] = [generation, batches[-1] if batches else -1]
    anew = any(now[t][0] != at["seen"].get(t, [None])[0] for t in now)
    if now == at["seen"]:
        return {name: [] for name in FACTS}
    every = {t: raw_batches(spark, raw, t, now[t][0]).filter(F.col("load_batch") <= now[t][1]) for t in now}
    changed = every if anew else {t: rows.filter(F.col("load_batch") > at["seen"][t][1]) for t, rows in every.items()}
    days = {} if anew else {name: dict(own) for name, own in at["days"].items()}
    days = days or {name: {} for name in FACTS}

    def activity() -> tuple[dict[str, str], list[date]]:
        moved = changed["gps_events"].select("event_time").unionByName(changed["delivery_events"].select("event_time"))
        touched = _days(moved, F.to_date("event_time"))
        if not touched:
            return {}, []
        rollup = M.gps_day_rollup(S.stg_gps_events(_on(every["gps_events"], touched)))
        daily = M.fct_daily_activity(rollup, S.stg_delivery_events(_on(every["delivery_events"], touched)))
        return _write_days(daily, out, "fct_daily_activity"), touched

    def deliveries() -> tuple[dict[str, str], list[date]]:
        packages = None if anew else _kept(touched_packages(every, changed), "touched-packages")
        fresh = _kept(deliveries_of(every, packages), "fresh-deliveries")
        before = None if anew else read_fact(spark, out, "fct_deliveries", at)
        stale = [] if before is None else _days(before.join(packages, "package_id", "left_semi"), F.col("delivery_day"))
        touched = sorted({*stale, *_days(fresh, F.col("delivery_day"))})
        if not touched:
            return {}, []
        if before is not None:
            rest = before.filter(F.col("delivery_day").isin(touched)).join(packages, "package_id", "left_anti")
            fresh = fresh.unionByName(rest)
        return _write_days(fresh, out, "fct_deliveries"), touched

    # the two facts do not need each other: they are computed side by side
    with ThreadPoolExecutor() as pool:
        jobs = {"fct_daily_activity": pool.submit(activity), "fct_deliveries": pool.submit(deliveries)}
        done = {name: job.result() for name, job in jobs.items()}
    written = {name: own for name, (own, touched) in done.items() if touched}
    for name, (_, touched) in done.items():
        for day in touched:
            days[name].pop(day.isoformat(), None)
    for name, own in written.items():
        days[name] |= own
    if tested:
        new = {n: spark.read.parquet(f"{out}/{n}/run={next(iter(own.values()))}") for n, own in written.items() if own}
        gate("marts", new)
    path = f"{_versions_path(out)}/version={at['version'] + 1}"
    if file_exists(spark, path):
        raise RuntimeError(f"another refresh has written version {at['version'] + 1}")
    write_file(spark, path, json.dumps({"seen": now, "days": days}).encode())
    return {name: sorted(written.get(name, {})) for name in FACTS}
