"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b = F.radians(lat1.cast("double")), F.radians(lat2.cast("double"))
    dlat, dlon = b - a, F.radians(lon2.cast("double")) - F.radians(lon1.cast("double"))
    half = F.pow(F.sin(dlat / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(dlon / 2), F.lit(2.0))
    return F.asin(F.least(F.lit(1.0), F.sqrt(half))) * (2 * EARTH_RADIUS_KM)
