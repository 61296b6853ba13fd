"""Geographic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371000
METRES_PER_DEGREE = 111194.92664455873


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres."""
    a, b, c, d = (F.col(x) if isinstance(x, str) else x for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin(F.radians(c - a) / 2), 2) + F.cos(F.radians(a)) * F.cos(F.radians(c)) * F.pow(
        F.sin(F.radians(d - b) / 2), 2
    )
    return F.lit(2 * EARTH_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def unit_sphere(lat="lat", lon="lon") -> tuple[Column, Column, Column]:
    """x, y and z of a place on a sphere of radius 1."""
    a, b = (F.radians(F.col(x) if isinstance(x, str) else x) for x in (lat, lon))
    return F.cos(a) * F.cos(b), F.cos(a) * F.sin(b), F.sin(a)
