"""Column helpers: plain Catalyst expressions, no Python in the data path."""

from convoy.functions.geo import haversine_km, in_service_area, in_service_area_or_unknown
from convoy.functions.rates import percentage
from convoy.functions.times import boundary_diff, parse_iso_time, whole_seconds

__all__ = [
    "boundary_diff",
    "haversine_km",
    "in_service_area",
    "in_service_area_or_unknown",
    "parse_iso_time",
    "percentage",
    "whole_seconds",
]
