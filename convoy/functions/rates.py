"""Rates."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, rest: Column, digits: int = 2) -> Column:
    """``part`` in percent of ``part + rest``; null when there is nothing to divide by."""
    whole = part + rest
    return F.when(whole != 0, F.round(F.lit(100.0) * part / whole, digits))
