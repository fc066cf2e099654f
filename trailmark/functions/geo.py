"""Column expressions on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the clamp keeps antipodes from becoming NaN."""
    h = F.pow(F.sin((F.radians(lat2) - F.radians(lat1)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def chord(km: float) -> float:
    """Straight distance on the unit sphere between points ``km`` apart along it."""
    return 2.0 if km / EARTH_KM >= math.pi else 2 * math.sin(km / EARTH_KM / 2)


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    la, lo = F.radians(lat), F.radians(lon)
    return F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la)
