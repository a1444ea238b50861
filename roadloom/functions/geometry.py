"""Distances, angles and map projections as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# earth's diameter and radius in miles, the road factor of segment lengths.
DIAMETER, RADIUS, ROAD = 7926.2, 3963.1, 1.02112


def haversine(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Road miles between two points: the great circle times the road factor."""
    a, b, c, d = (F.radians(x) for x in (lat1, lng1, lat2, lng2))
    h = F.pow(F.sin((c - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), F.lit(2.0))
    return F.lit(DIAMETER) * F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * F.lit(ROAD)


def turn_angle(lat0: Column, lng0: Column, lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Degrees between the incoming and the outgoing chord at point 1, on the unit sphere."""
    xyz = []
    for lat, lng in ((lat0, lng0), (lat1, lng1), (lat2, lng2)):
        p, q = F.radians(lat), F.radians(lng)
        xyz.append((F.cos(q) * F.cos(p), F.sin(q) * F.cos(p), F.sin(p)))
    u = [b - a for a, b in zip(xyz[0], xyz[1], strict=True)]
    v = [c - b for b, c in zip(xyz[1], xyz[2], strict=True)]
    dot = u[0] * v[0] + u[1] * v[1] + u[2] * v[2]
    size = F.sqrt((u[0] * u[0] + u[1] * u[1] + u[2] * u[2]) * (v[0] * v[0] + v[1] * v[1] + v[2] * v[2]))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot, size)))))


def cosine_miles(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Miles by the law of cosines, without the road factor."""
    a, b, c, d = (F.radians(x) for x in (lat1, lng1, lat2, lng2))
    h = F.cos(a) * F.cos(c) * F.cos(d - b) + F.sin(a) * F.sin(c)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), h))) * F.lit(RADIUS)


def nearby(lat1: Column, lng1: Column, lat2: Column, lng2: Column, tolerance: float) -> Column:
    return (F.abs(lat1 - lat2) < tolerance) & (F.abs(lng1 - lng2) < tolerance)


def longitude_reach(lat: Column, miles: Column) -> Column:
    """Half the width in degrees of a circle's bounding box; 180 where the circle holds a pole."""
    r, p = miles / F.lit(RADIUS), F.radians(lat)
    inside = F.abs(p) + r < F.lit(math.pi / 2)
    return F.when(inside, F.degrees(F.asin(F.sin(r) / F.cos(p)))).otherwise(F.lit(180.0))


def wrapped(value: Column, limit: float) -> Column:
    """The value moved by whole turns into -limit .. limit."""
    turns = F.ceil((F.abs(value) - F.lit(limit)) / 360.0)
    return F.when(value > limit, value - turns * 360.0).when(value < -limit, value + turns * 360.0).otherwise(value)


def mercator_y(lat: Column) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def mercator_latitude(y: Column) -> Column:
    return F.degrees(2 * F.atan(F.exp(y)) - F.lit(math.pi / 2))
