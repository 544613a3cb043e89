"""Distances on the sphere and figures of rings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean radius of the earth.
EARTH_KM, EARTH_M = 6371.0, 6371000.0
#: Metres of a degree along a meridian, as used for areas.
METRES_PER_DEGREE = 111320.0


def _angle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * F.asin(F.least(F.sqrt(a), F.lit(1.0)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return _angle(lat1, lon1, lat2, lon2) * EARTH_KM


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return _angle(lat1, lon1, lat2, lon2) * EARTH_M


def unit_vector(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The place as a direction from the centre of the earth."""
    a, o = F.radians(lat), F.radians(lon)
    return F.cos(a) * F.cos(o), F.cos(a) * F.sin(o), F.sin(a)


def mean_place(lat: str, lon: str) -> tuple[Column, Column]:
    """Aggregates: latitude and longitude of the mean direction of places, whatever side of the date line they lie on."""
    x, y, z = (F.avg(v) for v in unit_vector(F.col(lat), F.col(lon)))
    return F.degrees(F.atan2(z, F.sqrt(x * x + y * y))), F.degrees(F.atan2(y, x))


def within(lat1: Column, lon1: Column, lat2: Column, lon2: Column, km: float) -> Column:
    return haversine_km(lat1, lon1, lat2, lon2) <= km


def _ring_pairs(ring: Column) -> Column:
    """Each point of a ring (array of structs with lat, lon) with the next; the last with the first."""
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.element_at(ring, i).alias("a"), F.element_at(ring, F.when(i == n, 1).otherwise(i + 1)).alias("b")))


def ring_area_m2(ring: Column) -> Column:
    """Shoelace area in square metres at the ring's mean latitude; 0 under three points."""
    twice = F.aggregate(_ring_pairs(ring), F.lit(0.0), lambda s, p: s + p["a"]["lat"] * p["b"]["lon"] - p["b"]["lat"] * p["a"]["lon"])
    mean = F.aggregate(ring, F.lit(0.0), lambda s, p: s + p["lat"]) / F.size(ring)
    return F.when(F.size(ring) < 3, F.lit(0.0)).otherwise(F.abs(twice) / 2 * (METRES_PER_DEGREE**2) * F.cos(F.radians(mean)))


def ring_perimeter_m(ring: Column) -> Column:
    """Length of the ring in metres; 0 under two points."""
    total = F.aggregate(_ring_pairs(ring), F.lit(0.0), lambda s, p: s + haversine_m(p["a"]["lat"], p["a"]["lon"], p["b"]["lat"], p["b"]["lon"]))
    return F.when(F.size(ring) < 2, F.lit(0.0)).otherwise(total)
