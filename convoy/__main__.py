"""Jobs for a scheduler, which looks at the exit status.

    spark-submit convoy/__main__.py quality LAKE      1 if an expectation fails
    spark-submit convoy/__main__.py load LAKE RAW     1 if a file cannot be read
    spark-submit convoy/__main__.py batch LAKE RAW OUT  1 if a gate fails
"""

import sys

from pyspark.sql import SparkSession

from convoy.plans.jobs import GateFailed, run_pipeline
from convoy.plans.quality import quality_report, quality_results
from convoy.schemas import EVENT_TYPES
from convoy.session import utc
from convoy.sources.manifest import read_lake
from convoy.sources.load import load_events


def quality(spark: SparkSession, lake: str) -> int:
    text, passed = quality_report(quality_results({t: read_lake(spark, lake, t) for t in EVENT_TYPES}))
    print(text)
    return 0 if passed else 1


def load(spark: SparkSession, lake: str, raw: str) -> int:
    summary = load_events(spark, lake, raw).collect()  # a row per table
    for row in summary:
        print(*(f"{k}={v}" for k, v in row.asDict().items()))
    return 1 if any(row.n_errors for row in summary) else 0


def batch(spark: SparkSession, lake: str, raw: str, out: str) -> int:
    try:
        run_pipeline(spark, lake, raw, out)
    except GateFailed as failed:
        print(failed)
        return 1
    return 0


def main(arguments: list[str]) -> int:
    commands = {"quality": quality, "load": load, "batch": batch}
    if not arguments or arguments[0] not in commands:
        print(__doc__)
        return 2
    spark = utc(SparkSession.builder.appName(f"convoy {arguments[0]}").getOrCreate())
    return commands[arguments[0]](spark, *arguments[1:])


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
