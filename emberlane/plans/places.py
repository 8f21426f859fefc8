"""Queries on the sphere, and on the table in which every key is written once."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.functions import sphere
from emberlane.operators import places
from emberlane.plans.catalog import query, table
from emberlane.session import shared_dir
from emberlane.sources.geocoding import nearest_address
from emberlane.streaming import sink

# Rings [lon, lat] of shapes: over the antimeridian, over the north pole, with a hole, large, small, and of two parts.
RINGS = [
    (1, 0, [(170.0, -10.0), (-165.0, -12.0), (-170.0, 15.0), (175.0, 20.0)]),
    (2, 0, [(0.0, 70.0), (60.0, 65.0), (120.0, 72.0), (180.0, 60.0), (-120.0, 70.0), (-60.0, 66.0)]),
    (3, 0, [(0.0, 0.0), (50.0, 5.0), (20.0, 45.0)]), (3, 0, [(15.0, 10.0), (30.0, 10.0), (22.0, 25.0)]),
    (4, 0, [(-120.0, -50.0), (-50.0, -55.0), (-45.0, 20.0), (-85.0, 5.0), (-110.0, 30.0)]),
    (5, 0, [(10.0, 50.0), (10.5, 50.0), (10.4, 50.6)]),
    (6, 0, [(100.0, -30.0), (120.0, -30.0), (110.0, -10.0)]), (6, 1, [(130.0, -40.0), (150.0, -40.0), (150.0, -20.0), (130.0, -20.0)]),
]
_R = ", ".join(f"({s}, {p}, {r}, {k}, {x}::double, {y}::double)" for r, (s, p, v) in enumerate(RINGS) for k, (x, y) in enumerate([*v, v[0]]))


def spot(n: Column, a: float = 137.50776, b: float = 0.6180339887) -> tuple[Column, Column]:
    """A longitude and latitude that a number tells, spread over the sphere."""
    return (n * a) % 360.0 - 180.0, F.degrees(F.asin((n * b) % 1.0 * 2.0 - 1.0))


def _spot(n: str, a: float = 137.50776, b: float = 0.6180339887) -> str:
    return f"({n} * {a}::double) % 360 - 180 lon, degrees(asin(({n} * {b}::double) % 1 * 2 - 1)) lat"


def shapes(spark) -> DataFrame:
    parts: dict[int, dict[int, list]] = {}
    for s, p, v in RINGS:
        parts.setdefault(s, {}).setdefault(p, []).append([[float(x), float(y)] for x, y in [*v, v[0]]])
    return spark.createDataFrame([(s, list(x.values())) for s, x in parts.items()], "shape int, polygons array<array<array<array<double>>>>")


@query(f"""with r(shape, part, ring, k, x, y) as (values {_R}), e as (select event_id, {_spot('event_id')} from events),
b as (select event_id, lon, lat, shape, part, ring, k, x, y, atan2(sin(radians(x - lon)) * cos(radians(y)), cos(radians(lat)) * sin(radians(y)) - sin(radians(lat)) * cos(radians(y)) * cos(radians(x - lon))) bearing,
  sin(radians(lat)) * sin(radians(y)) + cos(radians(lat)) * cos(radians(y)) * cos(radians(x - lon)) near from e, r),
s as (select *, lead(bearing) over (partition by event_id, ring order by k) - bearing turn from b),
t as (select event_id, shape, part, ring, sum(turn - 2 * pi() * floor((turn + pi()) / (2 * pi()))) turns, sum(near) filter (turn is not null) near from s group by all)
select distinct event_id, shape from t where abs(turns) > pi() and near > 0 group by event_id, shape, part having count(*) % 2 = 1""")
def sphere_within(spark, sf_dir):
    lon, lat = spot(F.col("event_id"))
    points = table(spark, sf_dir, "events").select("event_id", lon.alias("lon"), lat.alias("lat"))
    return places.within(places.covering(shapes(spark)), points).select("event_id", "shape").distinct()


_KM = f"2 * asin(least(1, sqrt(sin(radians(p.lat - a.lat) / 2) ** 2 + cos(radians(a.lat)) * cos(radians(p.lat)) * sin(radians(p.lon - a.lon) / 2) ** 2))) * {sphere.RADIUS_KM}"


@query(f"""with a as (select c_custkey, {_spot('c_custkey')} from customer), p as (select s_suppkey, n_name, {_spot('s_suppkey', 99.3, 0.7548776)} from supplier left join nation on n_nationkey = s_nationkey),
d as (select c_custkey, s_suppkey, n_name, {_KM} km from a, p)
select c_custkey, s_suppkey, n_name as country, round(km, 3) km from d qualify row_number() over (partition by c_custkey order by round(km, 6), s_suppkey) = 1""")
def nearest_place(spark, sf_dir):
    lon, lat = spot(F.col("c_custkey"))
    assets = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("GeoAssetID"), lon.alias("Longitude"), lat.alias("Latitude"))
    x, y = spot(F.col("s_suppkey"), 99.3, 0.7548776)
    known = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.col("s_suppkey").alias("id"), x.alias("lon"), y.alias("lat"), F.col("n_name").alias("country"))
    return nearest_address(assets, known).select(F.col("GeoAssetID").alias("c_custkey"), F.col("place").alias("s_suppkey"), "country", F.round("km", 3).alias("km"))


@query("""with a as (select c_custkey id, 'customer' kind from customer where c_acctbal > 0), o as (select distinct o_custkey id, 'order' kind from orders), c as (select c_custkey id, 'late' kind from customer)
select * from a union all select * from o where id not in (select id from a) union all select * from c where id not in (select id from a) and id not in (select id from o)""")
def insert_once(spark, sf_dir):
    """Customers in credit, whoever orders, and all customers, by two writers, each batch twice."""
    path = f"{shared_dir(spark)}/once-{uuid.uuid4().hex}"
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    row = lambda df, key, kind: df.select(F.col(key).alias("id"), F.lit(kind).alias("kind"))
    batches = [("a", 0, row(c.where("c_acctbal > 0"), "c_custkey", "customer")), ("b", 0, row(o, "o_custkey", "order")), ("a", 1, row(c, "c_custkey", "late"))]
    for writer, number, batch in batches + batches:
        sink.write(batch, path, "id", writer, number)
    return sink.table(spark, path)
