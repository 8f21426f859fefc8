"""Geometry on the sphere against winding numbers and all pairs."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from emberlane.functions import sphere
from emberlane.operators import places, resolve

DEEP = "array<array<array<array<double>>>>"


def unit(lon, lat):
    a, b = np.radians(lon), np.radians(lat)
    return np.stack([np.cos(b) * np.cos(a), np.cos(b) * np.sin(a), np.sin(b)], -1)


def turns(ring, lon, lat):
    """How often a ring winds around a point, less around its antipode."""
    v = unit(*np.array(ring[:-1]).T)
    p = unit(lon, lat)
    east = np.array([-math.sin(math.radians(lon)), math.cos(math.radians(lon)), 0])
    north = np.cross(p, east)
    bearing = np.arctan2(v @ east, v @ north)
    step = np.diff(np.append(bearing, bearing[0]))
    return round(float(((step + np.pi) % (2 * np.pi) - np.pi).sum() / (2 * np.pi)))


def holds(polygons, lon, lat):
    """For polygons well under a hemisphere: the point is on their side of the sphere."""
    inside = lambda r: turns(r, lon, lat) != 0 and unit(lon, lat) @ unit(*np.array(r[:-1]).T).sum(0) > 0
    return any(inside(p[0]) and not any(inside(h) for h in p[1:]) for p in polygons)


def blob(rng, lon, lat, size, n):
    """A star around a place, in true angles, over poles and the antimeridian too."""
    c = unit(lon, lat)
    east = np.array([-math.sin(math.radians(lon)), math.cos(math.radians(lon)), 0])
    north = np.cross(c, east)
    out = []
    for k in range(n):
        r, t = math.radians(size * rng.uniform(0.5, 1)), 2 * math.pi * k / n
        p = c * math.cos(r) + (east * math.cos(t) + north * math.sin(t)) * math.sin(r)
        out.append([math.degrees(math.atan2(p[1], p[0])), math.degrees(math.asin(p[2]))])
    return [*out, out[0]]


def shapes_and_points(seed=1):
    rng = random.Random(seed)
    shapes = {
        1: [[blob(rng, 10, 50, 8, 7)]], 2: [[blob(rng, 179, -10, 12, 90)]], 3: [[blob(rng, 0, 90, 20, 40)]], 4: [[blob(rng, 70, -88, 10, 11)]],
        5: [[blob(rng, -100, 40, 20, 300), blob(rng, -100, 40, 6, 50)], [blob(rng, -100, 40, 2, 9)]], 6: [[[[0, 0], [40, 0], [40, 40], [0, 40], [0, 0]]]], 7: [[blob(rng, -60, 5, 0.02, 20)]],
        8: [[[[20.0, 60.0], [80.0, 60.0], [0.0, 90.0], [20.0, 60.0]]]],
    }
    points = [(math.degrees(2 * math.pi * rng.random()) - 180, math.degrees(math.asin(2 * rng.random() - 1))) for _ in range(700)]
    for p in shapes.values():
        for ring in p[0]:
            points += [(x + rng.gauss(0, 2), max(-90, min(90, y + rng.gauss(0, 2)))) for x, y in rng.sample(ring, min(12, len(ring)))]
    points += [(20.0, 40.5), (20.0, 0.5), (180.0, -10.0), (-180.0, -10.0), (500.0, 1.0)] + [(-60 + rng.gauss(0, 0.01), 5 + rng.gauss(0, 0.01)) for _ in range(30)]
    return shapes, points


def frames(spark, shapes, points):
    deep = [(k, [[[[float(a), float(b)] for a, b in r] for r in p] for p in v]) for k, v in shapes.items()]
    return spark.createDataFrame(deep, f"shape int, polygons {DEEP}"), spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id long, lon double, lat double")


def test_points_in_polygons_on_the_sphere(spark):
    shapes, points = shapes_and_points()
    s, p = frames(spark, shapes, points)
    cells = places.covering(s).cache()
    got = {(r["shape"], r["id"]) for r in places.within(cells, p).select("shape", "id").collect()}
    flat = {k: v for k, v in shapes.items() if k != 8}
    want = {(k, i) for k, v in flat.items() for i, (x, y) in enumerate(points) if holds(v, x, y)}
    assert {x for x in got if x[0] != 8} == want and {k for k, _ in want} == set(flat)
    # a triangle with a corner at the pole: all between its meridians, north of the arc
    assert {i for k, i in got if k == 8} == {i for i, (x, y) in enumerate(points) if 20 < x < 80 and math.tan(math.radians(y)) * math.sin(math.radians(60)) > math.tan(math.radians(60)) * (math.sin(math.radians(80 - x)) + math.sin(math.radians(x - 20)))}
    # an arc between equal latitudes lies north of the parallel
    at = {p: i for i, p in enumerate(points)}
    assert (6, at[20.0, 40.5]) in got and (2, at[180.0, -10.0]) in got and (2, at[-180.0, -10.0]) in got
    # most of a large polygon is accepted without a vertex
    inner = cells.where("shape = 5 and size(edges) = 0")
    assert inner.count() > 0 and places.within(inner, p).count() > 0.5 * places.within(cells.where("shape = 5"), p).count()
    assert places.covering(s.limit(0)).count() == 0 and places.within(cells, p.limit(0)).count() == 0


def test_cells_do_not_overlap(spark):
    shapes, points = shapes_and_points(3)
    for polygons in shapes.values():
        for rings in polygons:
            cells = {(level, x, y) for level, x, y, _, _ in places.cover(rings)}
            assert not any((lv - k, x >> 3 * k, y >> 3 * k) in cells for lv, x, y in cells for k in range(1, lv))


def test_nearest_against_all_pairs(spark):
    rng = random.Random(5)
    spot = lambda: (math.degrees(2 * math.pi * rng.random()) - 180, math.degrees(math.asin(2 * rng.random() - 1)))
    dense = [(2.35 + rng.gauss(0, 0.01), 48.85 + rng.gauss(0, 0.01)) for _ in range(300)]
    known = [spot() for _ in range(60)] + dense + [dense[0], (180.0, 0.0), (0.0, 90.0), (0.0, -90.0)]
    asked = [spot() for _ in range(300)] + dense[:50] + [(x + 0.001, y) for x, y in dense[:50]] + [(-179.9, 0.1), (77.0, 89.0), (0.0, -90.0), (180.0, 1.0)]
    p = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(asked)] + [(9000, None, 1.0), (9001, 1.0, 95.0)], "id long, lon double, lat double")
    q = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(known)] + [(-5, None, None)], "id long, lon double, lat double")
    got = {r["id"]: (r["place"], r["km"]) for r in places.nearest(p, q).collect()}
    a, b = unit(*np.array(asked).T), unit(*np.array(known).T)
    km = 2 * np.arcsin(np.minimum(1, np.linalg.norm(a[:, None] - b[None], axis=2) / 2)) * sphere.RADIUS_KM
    assert got.pop(9000) == (None, None) and got.pop(9001) == (None, None) and len(got) == len(asked)
    for i, (place, d) in got.items():
        assert abs(d - km[i].min()) < 1e-4 and km[i, place] < km[i].min() + 1e-4
    assert got[300][0] == 60  # of two places at one spot the smaller id
    assert {r["place"] for r in places.nearest(p, q.limit(0)).collect()} == {None}


def test_one_polygon_with_all_points_is_dealt(spark):
    """Points of one country go by cell."""
    ring = [[-100.0, 30.0], [-80.0, 30.0], [-80.0, 45.0], [-100.0, 45.0], [-100.0, 30.0]]
    rng = random.Random(2)
    pts = [(rng.uniform(-99, -81), rng.uniform(31, 44)) for _ in range(500)]
    s, p = frames(spark, {1: [[ring]]}, pts)
    held = resolve.contents(s, p)
    assert held.count() == 500
    cells = places.covering(s)
    each = places.within(cells, p).join(cells.select("shape").distinct(), "shape")
    assert each.count() == 500 and cells.count() >= 1


def test_box_distance(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(200):
        w, s = rng.uniform(-180, 170), rng.uniform(-90, 80)
        rows.append((rng.uniform(-180, 180), rng.uniform(-90, 90), w, w + rng.uniform(0.1, 10), s, min(90.0, s + rng.uniform(0.1, 10))))
    df = spark.createDataFrame(rows, "x double, y double, w double, e double, s double, n double")
    got = [r[0] for r in df.select(sphere.to_box(*[F.col(c) for c in ("x", "y", "w", "e", "s", "n")])).collect()]
    for (x, y, w, e, s, n), d in zip(rows, got):
        lon, lat = np.meshgrid(np.linspace(w, e, 60), np.linspace(s, n, 60))
        true = 2 * np.arcsin(np.minimum(1, np.linalg.norm(unit(lon, lat) - unit(x, y), axis=-1) / 2)).min()
        assert d <= true + 1e-9 and true - d < math.radians(0.3)


def test_groups_stand_for_their_members(spark):
    """Tags by group resolve as tags with each member do, and no item meets all members."""
    import datetime

    from emberlane.operators import resolve

    rng = random.Random(5)
    day = lambda n: datetime.datetime(2020, 1, 1) + datetime.timedelta(n)
    assets = spark.createDataFrame([(i, f"a{i}", day(rng.choice([0, 0, 3])), rng.choice([None, day(2), day(9)]), float(i % 8), float(i % 5)) for i in range(40)] + [(3, "twice", day(0), None, 3.0, 3.0)], "id long, name string, begin timestamp_ntz, end timestamp_ntz, lon double, lat double")
    members = [(f"c{i % 4}", i) for i in range(40)] + [(f"o{i % 3}", i) for i in range(40)] + [("o9", i) for i in range(6)] + [("c9", None)]
    items, tags, groups, places = [], [], [], []
    for i in range(160):
        items.append((i, day(rng.choice([0, 1, 4, 20]))))
        for kind, some in (("refname", 0), ("cityname", 4), ("ownername", 3)):
            if rng.random() < 0.4:
                tags += [(i, rng.randrange(40), kind) for _ in range(rng.randrange(1, 4))]
            if some and rng.random() < 0.5:
                groups += [(i, f"{kind[0]}{rng.choice([*range(some), 9, 77])}", kind) for _ in range(rng.randrange(1, 3))]
        if rng.random() < 0.6:
            places += [(i, p, p) for p in rng.sample([1, 2], rng.randrange(1, 3))]
    square = lambda w, e, s, n: [[[[w, s], [e, s], [e, n], [w, n], [w, s]]]]
    shapes = spark.createDataFrame([(1, square(0.5, 4.5, 0.5, 3.5)), (2, square(-0.5, 2.5, -0.5, 4.5))], "shape int, polygons array<array<array<array<double>>>>")
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    items = frame(items, "item long, ts timestamp_ntz")
    places = frame(places, "item long, place int, shape int")
    g, m = frame(groups, "item long, group string, type string"), frame(members, "group string, id long")
    plain, full = frame(tags, "item long, id long, type string"), frame(tags + [(i, d, t) for i, x, t in groups for y, d in members if x == y], "item long, id long, type string")
    told = lambda d: sorted((r["item"], r["stage"], r["n"], [(x["GeoAssetID"], x["GeoAssetName"]) for x in r["ref_match"]]) for r in d.collect())
    for where in ({}, {"places": places, "shapes": shapes}):
        each = told(resolve.resolve(items, full, assets, as_of="2021-01-01", **where))
        assert told(resolve.resolve(items, plain, assets, as_of="2021-01-01", groups=g, members=m, **where)) == each and len({x[1] for x in each}) > 2
    both = lambda d: sorted(map(tuple, d.distinct().collect()))
    assert both(resolve.in_all_types(plain, g, m)) == both(resolve.in_all_types(full))


def test_a_shared_answer_is_told_once(spark):
    """Items of many times get the same assets: these are put together once for each set, not for each time or item."""
    import datetime

    day = lambda n: datetime.datetime(2020, 1, 1) + datetime.timedelta(n)
    rows = [(i, f"a{i}", None if i % 4 == 3 else day(i % 2 * 100), day(150) if i % 3 else None) for i in range(30)]
    assets = spark.createDataFrame(rows, "id long, name string, begin timestamp_ntz, end timestamp_ntz")
    members = spark.createDataFrame([(f"o{i % 2}", i) for i in range(30)], "group string, id long")
    items = [(i, day(i * 401 % 1200)) for i in range(600)] + [(i, day(20)) for i in range(600, 1800)]
    groups = spark.createDataFrame([(i, f"o{i % 2}", "ownername") for i, _ in items], "item long, group string, type string")
    made, tags = spark.sparkContext.accumulator(0), spark.createDataFrame([(0, None, "refname")], "item long, id long, type string")

    @F.udf("string")
    def ids(ref):
        made.add(1)
        return ",".join(str(r["GeoAssetID"]) for r in ref)

    got = resolve.resolve(spark.createDataFrame(items, "item long, ts timestamp_ntz"), tags, assets, as_of="2021-01-01", groups=groups, members=members, tell=lambda ref: {"ids": ids(ref)}).collect()
    now = lambda ts, b, e: (b or day(-999)) <= ts <= (e or day(366))
    expected = {i: [d for d, _, b, e in rows if d % 2 == i % 2 and now(ts, b, e)] for i, ts in items}
    assert {r["item"]: (r["stage"], r["n"], r["ids"]) for r in got} == {i: (3, len(v), ",".join(map(str, v))) for i, v in expected.items() if v} and len(got) > 1300
    assert 0 < made.value <= len({tuple(v) for v in expected.values()})
