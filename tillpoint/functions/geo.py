"""Geodesic helpers as Column expressions (replaces a per-row Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.009  # mean Earth radius used by great-circle distance


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; the sqrt argument is clamped to 1."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dphi = F.radians(lat2) - F.radians(lat1)
    dlmb = F.radians(lon2) - F.radians(lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
