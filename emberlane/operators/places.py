"""Spatial joins on the sphere: points in polygons, and the nearest place.

Polygons are indexed by a covering of cells of longitude and latitude, eight by eight
of which make one of the level above. A cell that no edge touches is inside or outside
as a whole: inner cells are kept at the highest level that holds, and take their points
without looking at a vertex. Cells on a border are divided down to LEVELS levels or
until few edges are left, and keep the edges that lie in them or north of them; a point
is inside if the meridian to the north pole crosses an odd number of these (or an even
one, where the pole is inside). Points meet cells of all levels by equality, so a
polygon's points are dealt over tasks by cell and not by polygon.

As usual for such indexes, a polygon is the smaller of the two sides of its ring, may
lie over a pole or the antimeridian, and holes are out. The covering is a table and can
be kept like any other.

The nearest place is searched top down in a tree of cells: of the cells that may hold
it, those go whose nearest point is farther than some place that is known; that bound
is exact, and only few cells are left for a point at each level, however dense the
places are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from emberlane.functions import sphere
from emberlane.session import materialize, ship

LEVELS = 4  # of a covering: cells of 45 by 22.5 degrees, to 0.09 by 0.04
FEW = 16  # edges that are not worth dividing a cell for
DEPTH = 8  # of the tree of places: cells a quarter as wide each
BROADCAST_DEPTH = 3  # 16**3 cells at most


def _wrap(d):
    return d - 360 * np.floor((d + 180) / 360)


def ring_edges(ring: list) -> tuple[np.ndarray, bool]:
    """Edges (x1, y1, x2, y2) of a ring, and whether the north pole is inside. A vertex
    at a pole becomes two, at its neighbours' longitudes."""
    p = [(float(x), float(y)) for x, y in ring]
    if p and p[0] == p[-1]:
        p = p[:-1]
    v = []
    for i, (x, y) in enumerate(p):
        v += [(p[i - 1][0], y), (p[(i + 1) % len(p)][0], y)] if abs(y) == 90 else [(x, y)]
    v = np.array(v).reshape(-1, 2)
    e = np.concatenate([v, np.roll(v, -1, 0)], 1)
    e = e[(e[:, :2] != e[:, 2:]).any(1)]
    if not len(e):
        return e, False
    dlon = _wrap(e[:, 2] - e[:, 0])
    # area between an arc and the equator, signed by its direction
    a, b = np.tan(np.radians(e[:, 1]) / 2), np.tan(np.radians(e[:, 3]) / 2)
    area = 2 * np.arctan2(np.tan(np.radians(dlon) / 2) * (a + b), 1 + a * b)
    whole, around = float(area.sum()), float(dlon.sum())
    if abs(around) > 180:  # the ring goes around a pole: the smaller side is north where the ring lies north
        return e, around * whole > 0
    return e, abs(whole) > 2 * np.pi


def _extent(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """West and east (beyond 180 where an arc crosses the antimeridian), south and
    north of arcs; their highest points may lie between their ends."""
    dlon = _wrap(e[:, 2] - e[:, 0])
    west, east = np.minimum(e[:, 0], e[:, 0] + dlon), np.maximum(e[:, 0], e[:, 0] + dlon)
    lon, lat = np.radians(e[:, [0, 2]]), np.radians(e[:, [1, 3]])
    x, y, z = np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)
    nx, ny, nz = y[:, 0] * z[:, 1] - z[:, 0] * y[:, 1], z[:, 0] * x[:, 1] - x[:, 0] * z[:, 1], x[:, 0] * y[:, 1] - y[:, 0] * x[:, 1]
    size = np.sqrt(nx * nx + ny * ny + nz * nz)
    top = np.degrees(np.arccos(np.clip(np.abs(nz) / np.maximum(size, 1e-300), 0, 1)))
    at = np.degrees(np.arctan2(-ny * nz, -nx * nz))  # where the circle is highest
    between = lambda t: _wrap(t - west) % 360 <= east - west
    south, north = np.minimum(e[:, 1], e[:, 3]), np.maximum(e[:, 1], e[:, 3])
    north = np.where(between(at) & (size > 1e-15), np.maximum(north, top), north)
    south = np.where(between(at + 180) & (size > 1e-15), np.minimum(south, -top), south)
    half = np.abs(dlon) >= 180 - 1e-9  # over a pole
    return west, east, np.where(half, -90.0, south) - 1e-9, np.where(half, 90.0, north) + 1e-9


def _crossed(e: np.ndarray, lon: float, lat: float) -> int:
    """As sphere.crossed()."""
    a, b = _wrap(e[:, 0] - lon), _wrap(e[:, 2] - lon)
    i = np.flatnonzero(((a < 0) != (b < 0)) & (np.abs(b - a) <= 180))
    e, a, b = e[i], a[i], b[i]
    tan, sin = (lambda d: np.tan(np.radians(d))), (lambda d: np.sin(np.radians(d)))
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (tan(e[:, 1]) * sin(b) - tan(e[:, 3]) * sin(a)) / sin(b - a)
    return int(np.where(np.abs(b - a) == 180, e[:, 1] + e[:, 3] >= 0, at > np.tan(np.radians(lat))).sum())


def cover(rings: list) -> Iterator[tuple[int, int, int, bool, np.ndarray]]:
    """level, cx, cy, flip and edges of a polygon's cells (inner ones have no edges)."""
    told = [ring_edges(r) for r in rings]
    e = np.concatenate([x for x, _ in told]) if told else np.zeros((0, 4))
    if not len(e):
        return
    flip = bool(sum(p for _, p in told) % 2)
    west, east, south, north = _extent(e)
    todo = [(0, 0, 0, np.arange(len(e)))]
    while todo:
        level, cx, cy, mine = todo.pop()
        n = 8**level
        w, s = cx * 360 / n - 180, cy * 180 / n - 90
        z, t = w + 360 / n, s + 180 / n
        beside = np.zeros(len(mine), bool)
        for turn in (-360, 0, 360):
            beside |= (west[mine] + turn <= z) & (east[mine] + turn >= w)
        mine = mine[beside & (north[mine] >= s)]  # in the cell or north of it
        if not (south[mine] <= t).any():
            if (_crossed(e[mine], (w + z) / 2, (s + t) / 2) % 2 == 1) != flip:
                if level:
                    yield level, cx, cy, True, e[:0]
                    continue
            else:
                continue
        if level and (level == LEVELS or len(mine) <= FEW):
            yield level, cx, cy, flip, e[mine]
        else:
            todo += [(level + 1, cx * 8 + i, cy * 8 + j, mine) for i in range(8) for j in range(8)]


_EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def covering(shapes: DataFrame) -> DataFrame:
    """shape, level, cx, cy, flip, edges of every cell of each shape's polygons.
    shapes: shape, polygons."""
    rest = T.StructType.fromDDL(f"level int, cx int, cy int, flip boolean, edges {_EDGES}")
    schema = T.StructType([shapes.schema["shape"], *rest])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(c, pa.float64()) for c in ("x1", "y1", "x2", "y2")]))
        for b in batches:
            for i, rings in enumerate(b.column("rings").to_pylist()):
                cells = list(cover(rings or []))
                for lo in range(0, len(cells), 2000):
                    level, cx, cy, flip, edges = zip(*cells[lo : lo + 2000])
                    told = [[dict(zip(("x1", "y1", "x2", "y2"), r)) for r in x.tolist()] for x in edges]
                    who = b.column("shape").take(pa.array([i] * len(level)))
                    yield pa.RecordBatch.from_arrays([who, pa.array(level, pa.int32()), pa.array(cx, pa.int32()), pa.array(cy, pa.int32()), pa.array(flip), pa.array(told, kind)], schema.names)

    ship(shapes.sparkSession)
    return shapes.select("shape", F.explode("polygons").alias("rings")).mapInArrow(run, schema)


def _cell(lon: Column, lat: Column, n: Column) -> tuple[Column, Column]:
    """Of n by n cells, that of a point; the last ones are closed."""
    at = lambda share: F.least(F.floor(share * n), n - 1).cast("int")
    return at((sphere.wrapped(lon) + 180) / 360), at((lat + 90) / 180)


def _on_earth(points: DataFrame) -> DataFrame:
    return points.where("lon between -1e6 and 1e6 and lat between -90 and 90")


def within(cells: DataFrame, points: DataFrame) -> DataFrame:
    """(shape, and points' columns) of the points (lon, lat) in each shape."""
    level = F.explode(F.sequence(F.lit(1), F.lit(LEVELS))).alias("level")
    each = _on_earth(points).select("*", level)
    cx, cy = _cell(F.col("lon"), F.col("lat"), F.pow(F.lit(8), F.col("level")).cast("int"))
    met = each.withColumns({"cx": cx, "cy": cy}).join(cells, ["level", "cx", "cy"])
    inside = (sphere.crossed(F.col("edges"), F.col("lon"), F.col("lat")) % 2 == 1) != F.col("flip")
    return met.where(inside).select("shape", *points.columns)


def _box(cx: Column, cy: Column, n: int) -> tuple[Column, Column, Column, Column]:
    return cx * 360 / n - 180, (cx + 1) * 360 / n - 180, cy * 180 / n - 90, (cy + 1) * 180 / n - 90


def nearest(points: DataFrame, places: DataFrame) -> DataFrame:
    """points with place (the nearest one's id; of equally near ones the smallest) and
    km. points: any columns, with lon and lat; places: id, lon, lat. Points without
    coordinates, and all if there are no places, have none."""
    at = _on_earth(points).select("lon", "lat").distinct()
    spots = materialize(_on_earth(places).groupBy("lon", "lat").agg(F.min("id").alias("id")), "places")
    level = F.explode(F.sequence(F.lit(1), F.lit(DEPTH))).alias("level")
    cx, cy = _cell(F.col("lon"), F.col("lat"), F.pow(F.lit(4), F.col("level")).cast("int"))
    tree = materialize(spots.select("id", "lon", "lat", level).withColumns({"cx": cx, "cy": cy}).groupBy("level", "cx", "cy").agg(F.min(F.struct("id", F.col("lon").alias("plon"), F.col("lat").alias("plat"))).alias("some")), "place-cells")
    left = at.withColumns({"px": F.lit(0), "py": F.lit(0)})
    for d in range(1, DEPTH + 1):
        cells = tree.where(F.col("level") == d).select("cx", "cy", F.floor(F.col("cx") / 4).cast("int").alias("px"), F.floor(F.col("cy") / 4).cast("int").alias("py"), "some.plon", "some.plat")
        met = left.join(F.broadcast(cells) if d <= BROADCAST_DEPTH else cells, ["px", "py"])
        lower = sphere.to_box(F.col("lon"), F.col("lat"), *_box(F.col("cx"), F.col("cy"), 4**d))
        upper = sphere.distance(F.col("lat"), F.col("plat"), F.col("plon") - F.col("lon"))
        bound = F.min("_upper").over(Window.partitionBy("lon", "lat"))
        left = met.withColumns({"_lower": lower, "_upper": upper}).withColumn("_bound", bound).where("_lower <= _bound + 1e-9").select("lon", "lat", F.col("cx").alias("px"), F.col("cy").alias("py"))
        if d in (BROADCAST_DEPTH, DEPTH):
            left = materialize(left, "near-cells")
    x, y = _cell(F.col("plon"), F.col("plat"), F.lit(4**DEPTH))
    leaves = spots.select("id", F.col("lon").alias("plon"), F.col("lat").alias("plat")).withColumns({"px": x, "py": y})
    km = F.round(sphere.distance(F.col("lat"), F.col("plat"), F.col("plon") - F.col("lon")) * sphere.RADIUS_KM, 6)
    best = left.join(leaves, ["px", "py"]).groupBy("lon", "lat").agg(F.min(F.struct(km.alias("km"), "id")).alias("_b")).select("lon", "lat", F.col("_b.id").alias("place"), F.col("_b.km").alias("km"))
    return points.join(best, ["lon", "lat"], "left").select(*points.columns, "place", "km")
