"""Geometry on the sphere, as column expressions. Longitudes and latitudes are in
degrees; edges are the shorter arcs of great circles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS_KM = 6371.0088  # the Earth's mean radius


def wrapped(degrees: Column) -> Column:
    """A difference of longitudes, from -180 to below 180."""
    return degrees - 360 * F.floor((degrees + 180) / 360)


def distance(lat1: Column, lat2: Column, dlon: Column) -> Column:
    """Radians between two points that are dlon degrees of longitude apart."""
    half = lambda x: F.pow(F.sin(F.radians(x) / 2), F.lit(2.0))
    return 2 * F.asin(F.least(F.lit(1.0), F.sqrt(half(lat2 - lat1) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(dlon))))


def to_box(lon: Column, lat: Column, west: Column, east: Column, south: Column, north: Column) -> Column:
    """Radians to the nearest point of a box of longitudes and latitudes: it lies on the
    nearer of its meridians (or the point's own, inside), where the great circle
    square to that meridian meets it, or at one of its ends."""
    inside = (lon >= west) & (lon <= east)
    dlon = F.when(inside, 0.0).otherwise(F.least(F.abs(wrapped(west - lon)), F.abs(wrapped(east - lon))))
    foot = F.degrees(F.atan2(F.sin(F.radians(lat)), F.cos(F.radians(lat)) * F.cos(F.radians(dlon))))
    ends = F.least(distance(lat, south, dlon), distance(lat, north, dlon))
    return F.when((foot >= south) & (foot <= north), distance(lat, foot, dlon)).otherwise(ends)


def crossed(edges: Column, lon: Column, lat: Column) -> Column:
    """How many edges (x1, y1, x2, y2) the meridian from the point to the north pole crosses."""
    tan = lambda d: F.tan(F.radians(d))
    sin = lambda d: F.sin(F.radians(d))

    def hit(e: Column) -> Column:
        a, b = wrapped(e["x1"] - lon), wrapped(e["x2"] - lon)
        beside = F.abs(b - a) <= 180  # else the arc goes round the other side
        at = (tan(e["y1"]) * sin(b) - tan(e["y2"]) * sin(a)) / F.nullif(sin(b - a), F.lit(0.0))
        over = F.when(F.abs(b - a) == 180, e["y1"] + e["y2"] >= 0).otherwise(at > tan(lat))  # an arc of opposite longitudes goes over a pole
        return ((a < 0) != (b < 0)) & beside & F.coalesce(over, F.lit(False))

    return F.size(F.filter(edges, hit))
