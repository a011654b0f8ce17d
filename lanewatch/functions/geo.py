"""Distances, circles and grid cells on the sphere."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed value: the sphere's radius in metres.
EARTH_RADIUS_M = 6_371_000.0
# Far above rounding errors: between bounds this much apart the distance itself decides.
_BOUNDS_MARGIN = 1e-9


def latitude_cosine(lat: Column) -> Column:
    return F.cos(F.radians(lat))


def haversine_m(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column,
    cos1: Column | None = None, cos2: Column | None = None,
) -> Column:
    """Great-circle distance in metres.

    The root's argument is held to 1, so antipodes do not become NaN.  The
    latitudes' cosines may be given where a row meets many others.
    """
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    cosines = (latitude_cosine(lat1) if cos1 is None else cos1) * (
        latitude_cosine(lat2) if cos2 is None else cos2)
    chord = F.pow(half_lat, F.lit(2)) + cosines * F.pow(half_lon, F.lit(2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(chord)))


def within_m(
    lat1: Column, lon1: Column, lat2: Column, lon2: Column, cos1: Column, cos2: Column,
    radius_m: float,
) -> Column:
    """Whether :func:`haversine_m` is at most the radius.

    As ``x**2 - x**4 / 12 <= 4 * sin(x / 2)**2 <= x**2`` for any angle, products alone tell it but for pairs whose distance is very nearly the radius, or for which the two
    bounds lie apart; only these have their distance taken.
    """
    north, east = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    north, east = north * north, east * east
    along = cos1 * cos2 * east
    flat = north + along
    bend = (north * north + along * east) * F.lit(1 / 12)
    half = radius_m / (2 * EARTH_RADIUS_M)
    limit = 4 * math.sin(half) ** 2 if half < math.pi / 2 else math.inf
    surely = flat <= F.lit(limit * (1 - _BOUNDS_MARGIN))
    perhaps = flat <= F.lit(limit * (1 + _BOUNDS_MARGIN)) + bend
    return surely | (perhaps & (haversine_m(lat1, lon1, lat2, lon2, cos1, cos2) <= radius_m))


def band_height_degrees(radius_m: float) -> float:
    """Height of a latitude band: the radius, plus room for rounding."""
    return math.degrees(radius_m / EARTH_RADIUS_M) * 1.0001


def latitude_band(lat: Column, radius_m: float) -> Column:
    return F.floor(lat / F.lit(band_height_degrees(radius_m)))


def cells_in_band(band: Column, radius_m: float) -> Column:
    """How many equal cells a latitude band is cut into.

    A cell is at least one radius wide at the band's edge nearer to a pole,
    one more band further on; at the poles one cell spans all longitudes.
    Points within the radius therefore lie in the same or touching cells.
    """
    height = band_height_degrees(radius_m)
    edge = F.greatest(F.abs(band), F.abs(band + 1)) + F.lit(1)
    narrowest = F.cos(F.radians(F.least(F.lit(90.0), edge * F.lit(height))))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0 / height / 1.01) * narrowest))


def cell_in_band(lon: Column, cells: Column) -> Column:
    """Cell number of a longitude, counted eastwards and wrapping at 180 degrees."""
    return F.pmod(F.floor((lon + F.lit(180.0)) / F.lit(360.0) * cells), cells)


def circle_ring(lat: Column, lon: Column, radius_m: float = 200.0, points: int = 64) -> Column:
    """A closed ring of [longitude, latitude] pairs around a point.

    The first pair stands again at the end, so there are ``points + 1`` pairs.
    """
    arc = F.lit(radius_m / EARTH_RADIUS_M)
    lat0, lon0 = F.radians(lat), F.radians(lon)

    def vertex(i: Column) -> Column:
        bearing = F.lit(2 * math.pi) * (i % points) / points
        sin_lat = F.sin(lat0) * F.cos(arc) + F.cos(lat0) * F.sin(arc) * F.cos(bearing)
        east = F.sin(bearing) * F.sin(arc) * F.cos(lat0)
        north = F.cos(arc) - F.sin(lat0) * sin_lat
        return F.array(F.degrees(lon0 + F.atan2(east, north)), F.degrees(F.asin(sin_lat)))

    return F.transform(F.sequence(F.lit(0), F.lit(points)), vertex)
