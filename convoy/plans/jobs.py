"""The batch job: load, staging, tests, marts, tests."""

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convoy.plans import marts as M
from convoy.plans.quality import table_tests
from convoy.plans.staging import staging_tables
from convoy.schemas import RAW_SCHEMAS
from convoy.sources.load import load_events, read_raw


SCHEMA = "fleet"


class GateFailed(Exception):
    """A table test failed; ``failures`` lists (table, test, column, failing)."""

    def __init__(self, stage: str, failures: list[tuple]):
        super().__init__(f"{stage}: {failures}")
        self.stage = stage
        self.failures = failures


def gate(stage: str, tables: dict[str, DataFrame]) -> None:
    """Raise unless all tests of the tables pass. Only failed tests reach the driver."""
    failures = table_tests(tables).filter("not success").collect()
    if failures:
        raise GateFailed(
            stage, [(r["table_name"], r["test"], r["column"], r["n_failing"]) for r in failures]
        )


def _store(table: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back."""
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _store_all(tables: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """Write tables that do not depend on each other side by side."""
    with ThreadPoolExecutor() as pool:
        stored = pool.map(lambda name: _store(tables[name], f"{out}/{name}"), tables)
        return dict(zip(tables, stored))


def publish(spark: SparkSession, schema: str, names: Iterable[str], out: str) -> None:
    """Let ``schema.name`` in the catalog show the table stored at ``out/name``, one switch per table: readers see the
    former table until then, and whole."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for name in names:
        spark.sql(f"CREATE OR REPLACE VIEW `{schema}`.`{name}` AS SELECT * FROM parquet.`{out}/{name}`")


def build_marts(staging: dict[str, DataFrame], out: str) -> dict[str, DataFrame]:
    """The five marts, written in the order they need each other."""
    now = F.current_timestamp()
    rollup = _store(M.gps_day_rollup(staging["stg_gps_events"]), f"{out}/gps_day_rollup")
    deliveries, drivers = staging["stg_delivery_events"], staging["stg_driver_events"]
    marts = {
        "dim_drivers": M.dim_drivers(drivers, deliveries, now),
        "dim_vehicles": M.dim_vehicles(rollup, now),
        "fct_deliveries": M.fct_deliveries(deliveries, staging["stg_orders"], drivers, now),
        "fct_daily_activity": M.fct_daily_activity(rollup, deliveries, now),
    }
    stored = _store_all(marts, out)
    calendar = M.dim_date(stored["fct_daily_activity"], F.current_date(), now)
    stored["dim_date"] = _store(calendar, f"{out}/dim_date")
    return stored


def run_batch(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    out: str,
    stored_staging: bool = True,
    schema: str = SCHEMA,
) -> dict[str, DataFrame]:
    """RAW tables to tested tables in a schema of the catalog; stops at the first failed gate.

    Every run writes to a folder of its own below ``out``. Only after a gate has passed do the names in
    ``schema`` show the new tables, so a failure leaves what was there.

    Staging tables are views of the session; with ``stored_staging`` they are written once and published instead,
    because the tests and several marts read them and would each repeat the deduplication.
    """
    out = f"{out}/run-{uuid.uuid4().hex[:12]}"
    for name, table in raw.items():
        table.createOrReplaceTempView(name)
    gate("raw", raw)
    staging = staging_tables(raw)
    if stored_staging:
        staging = _store_all(staging, f"{out}/staging")
    else:
        for name, table in staging.items():
            table.createOrReplaceTempView(name)
    gate("staging", staging)
    if stored_staging:
        publish(spark, schema, staging, f"{out}/staging")
    marts = build_marts(staging, f"{out}/marts")
    gate("marts", marts)
    publish(spark, schema, marts, f"{out}/marts")
    return {**staging, **marts}


def run_pipeline(spark: SparkSession, lake: str, raw: str, out: str) -> dict[str, DataFrame]:
    """Incremental load of the lake, then ``run_batch``."""
    load_events(spark, lake, raw).collect()
    return run_batch(spark, {table: read_raw(spark, raw, table) for table in RAW_SCHEMAS}, out)
