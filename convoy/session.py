"""Session settings and the folder for intermediate tables."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def utc(spark: SparkSession) -> SparkSession:
    """Days and ISO texts mean UTC, whatever the zone of the machine."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Jobs started inside run in the scheduler pool ``name``, and so do those of streams started inside.

    With ``spark.scheduler.mode`` FAIR, which a session is created with, pools share the executors evenly: a stream
    that is behind does not hold up the others. Without it pools have no effect.
    """
    context = spark.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder: a folder of
    one machine would be lost with that machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/convoy-{purpose}-{uuid.uuid4().hex[:12]}"
