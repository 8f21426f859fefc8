"""GeoJSON geometry on arrays, as column expressions. Edges are planar."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIUS = 6378137.0


def bbox_ring(south: Column, north: Column, west: Column, east: Column) -> Column:
    """A closed ring of five [lon, lat] vertices."""
    return F.array(F.array(west, south), F.array(east, south), F.array(east, north), F.array(west, north), F.array(west, south))


def polygon(ring: Column) -> Column:
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


def point(lon: Column, lat: Column) -> Column:
    return F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))


def _edges(ring: Column) -> Column:
    return F.zip_with(F.slice(ring, 1, F.size(ring) - 1), F.slice(ring, 2, F.size(ring) - 1), lambda a, b: F.named_struct(F.lit("x1"), F.get(a, F.lit(0)), F.lit("y1"), F.get(a, F.lit(1)), F.lit("x2"), F.get(b, F.lit(0)), F.lit("y2"), F.get(b, F.lit(1))))


def crossings(ring: Column, x: Column, y: Column) -> Column:
    """How often a ray from the point to the right crosses the ring."""
    hit = lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])
    return F.size(F.filter(_edges(ring), hit))


def in_polygon(rings: Column, x: Column, y: Column) -> Column:
    """Odd-even rule over all rings, so that holes are out."""
    return F.aggregate(rings, F.lit(0), lambda n, r: n + crossings(r, x, y)) % 2 == 1


def in_multipolygon(polygons: Column, x: Column, y: Column) -> Column:
    return F.exists(polygons, lambda p: in_polygon(p, x, y))


def ring_area(ring: Column) -> Column:
    """Area on a sphere in square metres: the sum of (lon_next - lon_before) * sin(lat) over the vertices."""
    n = F.size(ring) - 1
    lon = lambda i: F.radians(F.get(F.get(ring, F.pmod(i + n, n)), F.lit(0)))
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda i: (lon(i + 1) - lon(i - 1)) * F.sin(F.radians(F.get(F.get(ring, i), F.lit(1)))))
    return F.abs(F.aggregate(each, F.lit(0.0), lambda a, v: a + v)) * RADIUS * RADIUS / 2


def polygon_area(rings: Column) -> Column:
    """The outer ring's area without the holes'."""
    areas = F.transform(rings, ring_area)
    return 2 * F.get(areas, F.lit(0)) - F.aggregate(areas, F.lit(0.0), lambda a, v: a + v)


def multipolygon_area(polygons: Column) -> Column:
    return F.aggregate(F.transform(polygons, polygon_area), F.lit(0.0), lambda a, v: a + v)


def parts(rings: Column) -> Column:
    """The polygons that the rings of a flattened MultiPolygon make up: a ring in an
    even number of others is an outer one, and its holes are those one deeper in it.
    The middle of a ring's first edge tells what it lies in, as vertices may touch."""

    def within(r: Column, other: Column) -> Column:
        at = lambda k: (F.get(F.get(r, F.lit(0)), F.lit(k)) + F.get(F.get(r, F.lit(1)), F.lit(k))) / 2
        return crossings(other, at(0), at(1)) % 2 == 1

    told = F.transform(rings, lambda r, i: F.named_struct(F.lit("ring"), r, F.lit("depth"), F.size(F.filter(rings, lambda o, k: (k != i) & within(r, o)))))
    return F.transform(
        F.filter(told, lambda t: t["depth"] % 2 == 0),
        lambda t: F.concat(F.array(t["ring"]), F.transform(F.filter(told, lambda h: (h["depth"] == t["depth"] + 1) & within(h["ring"], t["ring"])), lambda h: h["ring"])),
    )


POLYGON, MULTIPOLYGON = "array<array<array<double>>>", "array<array<array<array<double>>>>"


def polygons(kind: Column, coordinates: Column, stored: str) -> Column:
    """The polygons of a Polygon's or MultiPolygon's coordinates, whatever type the
    table stores them as: either's own, or (where both are in one column) text or
    arrays of text."""
    if stored == MULTIPOLYGON:
        return coordinates
    if stored == POLYGON:
        return F.when(kind == "MultiPolygon", parts(coordinates)).otherwise(F.array(coordinates))
    text = F.regexp_replace(coordinates if stored == "string" else F.to_json(coordinates), r'["\s]', "")
    read = lambda as_: F.from_json(F.concat(F.lit('{"c":'), text, F.lit("}")), f"c {as_}")["c"]
    return F.when(text.startswith("[[[["), read(MULTIPOLYGON)).otherwise(polygons(kind, read(POLYGON), POLYGON))


EARTH = 4 * math.pi * RADIUS * RADIUS
