"""Geographic functions on columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = 111.32


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of points in degrees."""
    a, b, c, d = map(F.radians, (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.greatest(F.lit(0.0), F.least(F.lit(1.0), h))))


def gaussian_density(weight: Column, distance_km: Column, bandwidth_km: float) -> Column:
    """What a weight adds per square km at a distance."""
    return weight / (2 * math.pi * bandwidth_km**2) * F.exp(-F.pow(distance_km, 2) / (2 * bandwidth_km**2))


def log2_risk(part: Column, base: Column, rate: Column, smoothing: float) -> Column:
    """log2 of a density over that expected at the overall rate, both smoothed."""
    return F.log2((part / rate + smoothing) / (base + smoothing))


def inside(lat: Column, lon: Column, south: Column, north: Column, west: Column, east: Column) -> Column:
    return lat.between(south, north) & lon.between(west, east)
