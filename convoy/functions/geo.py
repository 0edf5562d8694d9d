"""Distances and the service-area box."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from convoy.schemas import EARTH_RADIUS_KM, LAT_MAX, LAT_MIN, LON_MAX, LON_MIN


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in km; null as soon as one coordinate is null."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    # Rounding may push the chord of two antipodes a hair above 1; null must stay null.
    rest = F.when(chord > 1, F.lit(0.0)).otherwise(1 - chord)
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(chord), F.sqrt(rest))


def in_service_area(lat: Column, lon: Column) -> Column:
    """Edges are inside; an unknown coordinate makes the answer null."""
    return lat.between(LAT_MIN, LAT_MAX) & lon.between(LON_MIN, LON_MAX)


def in_service_area_or_unknown(lat: Column, lon: Column) -> Column:
    """As ``in_service_area``, but an unknown coordinate is acceptable."""
    return (lat.isNull() | lat.between(LAT_MIN, LAT_MAX)) & (
        lon.isNull() | lon.between(LON_MIN, LON_MAX)
    )
