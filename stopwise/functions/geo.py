"""Great-circle distance and planar polygon tests on plain lon/lat columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopwise.config import EARTH_RADIUS_M

METRES_PER_DEGREE = EARTH_RADIUS_M * math.pi / 180


def sphere_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance in metres."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.asin(F.sqrt(F.least(chord, F.lit(1.0)))) * (2 * EARTH_RADIUS_M)


def ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs ``(a, b)`` of a closed ring of ``(lon, lat)`` structs."""
    count = F.size(ring)
    return F.transform(
        F.slice(ring, F.lit(1), F.greatest(count - 1, F.lit(0))),
        lambda a, i: F.struct(a.alias("a"), F.get(ring, i + 1).alias("b")),
    )


def polygon_contains(rings: Column, lon: Column, lat: Column) -> Column:
    """True for a point strictly inside; holes are further rings, boundary points are outside."""
    edges = F.flatten(F.transform(rings, ring_edges))

    def cross(e: Column) -> Column:
        return (e.b.lon - e.a.lon) * (lat - e.a.lat) - (e.b.lat - e.a.lat) * (lon - e.a.lon)

    def on_edge(e: Column) -> Column:
        return (
            (cross(e) == 0)
            & lon.between(F.least(e.a.lon, e.b.lon), F.greatest(e.a.lon, e.b.lon))
            & lat.between(F.least(e.a.lat, e.b.lat), F.greatest(e.a.lat, e.b.lat))
        )

    def crossed(e: Column) -> Column:
        # The half-open latitude test counts a vertex on the ray once.
        rising = (e.a.lat <= lat) & (lat < e.b.lat) & (cross(e) > 0)
        falling = (e.b.lat <= lat) & (lat < e.a.lat) & (cross(e) < 0)
        return rising | falling

    crossings = F.size(F.filter(edges, crossed))
    return ~F.exists(edges, on_edge) & (F.pmod(crossings, F.lit(2)) == 1)
