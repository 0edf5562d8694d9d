"""Time helpers that behave the same for TIMESTAMP and TIMESTAMP_NTZ columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso_time(text: Column) -> Column:
    """ISO-8601 text to timestamp; unreadable text becomes null also under ANSI mode."""
    return F.try_to_timestamp(text)


def whole_seconds(time: Column) -> Column:
    """Epoch seconds, fractions cut off."""
    return F.unix_seconds(time.cast("timestamp"))


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` boundaries between two times (00:00:59 to 00:01:01 is one minute)."""
    return F.timestamp_diff(
        unit.upper(),
        F.date_trunc(unit, start.cast("timestamp")),
        F.date_trunc(unit, end.cast("timestamp")),
    )
