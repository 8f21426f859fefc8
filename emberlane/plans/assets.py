"""Queries on assets: validity, candidates, resolution, countries, geometry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.functions import geo
from emberlane.operators import resolve, share
from emberlane.plans.catalog import query, table

AS_OF = "2024-06-01"


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers, valid for a time that their key tells, at a place that it tells."""
    s = table(spark, sf_dir, "supplier")
    begin = F.lit("1990-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("s_suppkey") % 4 * 700).cast("int"))
    end = F.lit("1996-01-01").cast("timestamp_ntz") + F.make_dt_interval((F.col("s_suppkey") % 3 * 900).cast("int"))
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), begin.alias("begin"), end.alias("end"), (F.col("s_suppkey") * 7 % 40 + 0.5).cast("double").alias("lon"), (F.col("s_suppkey") * 11 % 30 + 0.5).cast("double").alias("lat"), "s_nationkey")


_ASSETS = """a as (select s_suppkey id, s_name as name, timestamp '1990-01-01' + to_days((s_suppkey % 4 * 700)::int) b, timestamp '1996-01-01' + to_days((s_suppkey % 3 * 900)::int) e,
  s_suppkey * 7 % 40 + 0.5 lon, s_suppkey * 11 % 30 + 0.5 lat from supplier)"""


def candidates(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """tags, groups and members: suppliers of an order's lines, all of the first line's
    nation, and all whose key leaves the customer's remainder."""
    o, l, s = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "supplier"))
    typed = lambda d, t: d.withColumn("type", F.lit(t))
    nation = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string"))
    rest = lambda c: F.concat(F.lit("rest "), (F.col(c) % 5).cast("string"))
    ref = l.select(F.col("l_orderkey").alias("item"), F.col("l_suppkey").alias("id")).distinct()
    first = l.groupBy("l_orderkey").agg(F.min(F.struct("l_linenumber", "l_suppkey"))["l_suppkey"].alias("s_suppkey")).where("l_orderkey % 3 <> 0").join(s, "s_suppkey")
    city = first.select(F.col("l_orderkey").alias("item"), nation.alias("group"))
    own = o.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("item"), rest("o_custkey").alias("group"))
    groups = typed(city, "cityname").unionByName(typed(own, "ownername")).where("group is not null")
    members = s.select(nation.alias("group"), F.col("s_suppkey").alias("id")).unionByName(s.select(rest("s_suppkey").alias("group"), F.col("s_suppkey").alias("id")))
    return {"tags": typed(ref, "refname"), "groups": groups, "members": members.where("group is not null and id is not null").distinct()}


@query(f"with {_ASSETS} select l_orderkey item, count(*)::bigint n from (select distinct l_orderkey, l_suppkey from lineitem) l join orders on o_orderkey = l_orderkey join a on a.id = l_suppkey and b <= o_orderdate and e >= o_orderdate group by l_orderkey")
def valid_interval_join(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_orderdate").alias("ts"))
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), F.col("l_suppkey").alias("id")).distinct()
    now = resolve.valid(F.col("ts"), F.col("begin"), F.col("end"), F.lit(AS_OF))
    return l.join(assets(spark, sf_dir), "id").join(o, "item").where(now).groupBy("item").agg(F.count("*").alias("n"))


_COMB = """with refs as (select distinct l_orderkey item, l_suppkey id from lineitem),
city as (select l_orderkey item, b.s_suppkey id from (select l_orderkey, arg_min(l_suppkey, (l_linenumber, l_suppkey)) s from lineitem where l_orderkey % 3 <> 0 group by l_orderkey) f
  join supplier a on a.s_suppkey = f.s join supplier b on a.s_nationkey = b.s_nationkey)
select r.item, r.id from refs r where r.item % 3 = 0 or exists (select 1 from city c where c.item = r.item and c.id = r.id)"""


@query(_COMB)
def tag_intersection(spark, sf_dir):
    return resolve.in_all_types(**candidates(spark, sf_dir))


_RESOLVE = f"""with {_ASSETS}, refs as (select distinct l_orderkey item, l_suppkey id from lineitem),
city as (select l_orderkey item, b.s_suppkey id from (select l_orderkey, arg_min(l_suppkey, (l_linenumber, l_suppkey)) s from lineitem where l_orderkey % 3 <> 0 group by l_orderkey) f
  join supplier a on a.s_suppkey = f.s join supplier b on a.s_nationkey = b.s_nationkey),
own as (select o_orderkey item, s_suppkey id from orders join supplier on s_suppkey % 5 = o_custkey % 5 where o_orderkey % 4 = 0),
comb as (select r.item, r.id from refs r where r.item % 3 = 0 or exists (select 1 from city c where c.item = r.item and c.id = r.id)),
third as (select o.item, o.id from own o where (not exists (select 1 from comb c where c.item = o.item)) or exists (select 1 from comb c where c.item = o.item and c.id = o.id)),
s as (select item, id, 1 stage, 0 poly from refs union all select item, id, 2, 0 from comb union all select item, id, 3, 0 from third{{extra}}),
v as (select s.item, stage, poly, a.id from s join orders o on o.o_orderkey = s.item join a on a.id = s.id and b <= o_orderdate and e >= o_orderdate),
g as (select item, stage, poly, count(*)::bigint n, string_agg(id::varchar, ',' order by id) ids from v group by item, stage, poly)
select item, stage, n, ids, case when n = 8 then 0.12 else round(1 / n, 2) end::double confidence from g qualify row_number() over (partition by item order by n, stage, poly) = 1"""


def _told(ref: Column) -> dict[str, Column]:
    return {"ids": F.array_join(F.transform(ref, lambda r: r["GeoAssetID"].cast("string")), ","), "confidence": F.get(ref, F.lit(0))["confidence"]}


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("item"), F.col("o_orderdate").alias("ts"))


@query(_RESOLVE.format(extra=""))
def resolve_cascade(spark, sf_dir):
    return resolve.resolve(_items(spark, sf_dir), assets=assets(spark, sf_dir), as_of=AS_OF, tell=_told, **candidates(spark, sf_dir))


# orders of even keys name a box of 20 by 15 degrees, and those of keys divisible by 4 a box of 10 by 30 inside or beside it
_BOXES = [(2, 0, 5.0, 25.0, 5.0, 20.0), (4, 1, 0.0, 10.0, 0.0, 30.0)]
_POLY = """ union all select o_orderkey, a.id, 4, -1 from orders, a where o_orderkey % 2 = 0 and lon between 5 and 25 and lat between 5 and 20 and o_orderkey not in (select item from refs) and o_orderkey not in (select item from own)
  union all select o_orderkey, a.id, 4, 0 from orders, a where o_orderkey % 4 = 0 and lon between 0 and 10 and lat between 0 and 30 and o_orderkey not in (select item from refs) and o_orderkey not in (select item from own)
  union all select r.item, r.id, 4, 1 from refs r join a on a.id = r.id where r.item % 2 = 0 and lon between 5 and 25 and lat between 5 and 20
  union all select r.item, r.id, 4, 2 from refs r join a on a.id = r.id where r.item % 4 = 0 and lon between 0 and 10 and lat between 0 and 30
  union all select r.item, r.id, 4, 3 from own r join a on a.id = r.id where r.item % 2 = 0 and lon between 5 and 25 and lat between 5 and 20
  union all select r.item, r.id, 4, 4 from own r join a on a.id = r.id where r.item % 4 = 0 and lon between 0 and 10 and lat between 0 and 30
  union all select r.item, r.id, 4, 5 from refs r join own using (item, id) join a on a.id = r.id where r.item % 2 = 0 and lon between 5 and 25 and lat between 5 and 20
  union all select r.item, r.id, 4, 6 from refs r join own using (item, id) join a on a.id = r.id where r.item % 4 = 0 and lon between 0 and 10 and lat between 0 and 30"""


def boxes(spark: SparkSession) -> DataFrame:
    """The two boxes, the second as a MultiPolygon of its halves below and above 15."""
    square = lambda w, e, s, n: [[[w, s], [e, s], [e, n], [w, n], [w, s]]]
    (_, a, *box), (_, b, w, e, s, n) = _BOXES
    rows = [(a, [square(*box)]), (b, [square(w, e, s, 15.0), square(w, e, 15.0, n)])]
    return spark.createDataFrame(rows, "shape int, polygons array<array<array<array<double>>>>")


@query(_RESOLVE.format(extra=_POLY))
def resolve_places(spark, sf_dir):
    items = _items(spark, sf_dir)
    links = None
    for step, n, *_ in _BOXES:
        part = items.where(F.col("item") % step == 0).select("item", F.lit(n).alias("place"), F.lit(n).alias("shape"))
        links = part if links is None else links.unionByName(part)
    return resolve.resolve(items, assets=assets(spark, sf_dir), places=links, as_of=AS_OF, shapes=boxes(spark), tell=_told, **candidates(spark, sf_dir))


_MATCHES = "m as (select l_orderkey item, n_name country from lineitem join supplier on s_suppkey = l_suppkey left join nation on n_nationkey = s_nationkey and n_nationkey % 7 <> 0)"
_SHARES = f"""with {_MATCHES}, c as (select item, country, count(*) n from m group by item, country), w as (select item, country, n, sum(n) over (partition by item) whole from c),
s as (select item, country, n, round_even(n / whole * 100, 0) / 100 p from w where country is not null)"""


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    l, s, n = (table(spark, sf_dir, t) for t in ("lineitem", "supplier", "nation"))
    named = s.join(n.where("n_nationkey % 7 <> 0"), F.col("s_nationkey") == F.col("n_nationkey"), "left").select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("country"))
    return l.join(named, "l_suppkey").select(F.col("l_orderkey").alias("item"), "country")


@query(_SHARES + " select item, string_agg(country || ':' || p::varchar, ',' order by n desc, country) shares from s group by item")
def country_share(spark, sf_dir):
    t = share.country_shares(matches(spark, sf_dir)).where(F.size("country_match") > 0)
    return t.select("item", F.array_join(F.transform("country_match", lambda c: F.concat_ws(":", c["country"], c["p"].cast("string"))), ",").alias("shares"))


@query(_SHARES + " select item, arg_min(country, (-p, country)) country from s group by item")
def top_country(spark, sf_dir):
    t = share.country_shares(matches(spark, sf_dir)).where(F.size("country_match") > 0)
    return t.select("item", share.top_country(F.col("country_match")).alias("country"))


@query(_SHARES + " select distinct item from s where p > 0.5")
def any_element(spark, sf_dir):
    return share.country_shares(matches(spark, sf_dir)).where(F.exists("country_match", lambda c: c["p"] > 0.5)).select("item")


@query(_SHARES + " select item, country from s where p = 1")
def positional_element(spark, sf_dir):
    first = F.get("country_match", F.lit(0))
    return share.country_shares(matches(spark, sf_dir)).where(first["p"] == 1).select("item", first["country"].alias("country"))


_RING = [(-0.5, -0.5), (0.5, -0.5), (0.2, 0.0), (0.5, 0.5), (-0.5, 0.5), (-0.1, 0.1), (-0.5, -0.5)]


def _crossing(x: str, y: str) -> str:
    each = [f"(case when ({a[1]} > {y}) <> ({b[1]} > {y}) and {x} < ({b[0]} - {a[0]}) * ({y} - {a[1]}) / nullif({b[1]} - {a[1]}, 0) + {a[0]} then 1 else 0 end)" for a, b in zip(_RING, _RING[1:])]
    return " + ".join(each)


def _ring():
    return F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in _RING])


@query(f"select vec_id from (select vec_id, (embedding[1]::double - 0) * 4 x, embedding[2]::double * 4 y from embeddings) t where ({_crossing('x', 'y')}) % 2 = 1")
def point_in_polygon(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", (F.get("embedding", F.lit(0)).cast("double") * 4).alias("x"), (F.get("embedding", F.lit(1)).cast("double") * 4).alias("y"))
    return e.where(geo.in_polygon(F.array(_ring()), F.col("x"), F.col("y"))).select("vec_id")


@query("""select s_suppkey, round(abs((2 * radians(w)) * (sin(radians(s)) + sin(radians(s)) - sin(radians(s + h)) - sin(radians(s + h)))) / 2 * 6378137.0 * 6378137.0 / 1e6 / 2, 3) km2
from (select s_suppkey, (s_suppkey % 30)::double s, (s_suppkey % 5 + 1)::double h, (s_suppkey % 7 + 1)::double w from supplier) t""")
def polygon_area(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 30).cast("double").alias("s"), (F.col("s_suppkey") % 5 + 1).cast("double").alias("h"), (F.col("s_suppkey") % 7 + 1).cast("double").alias("w"))
    ring = geo.bbox_ring(F.col("s"), F.col("s") + F.col("h"), F.lit(0.0), F.col("w"))
    return s.select("s_suppkey", F.round(geo.polygon_area(F.array(ring)) / 1e6, 3).alias("km2"))


@query("""select s_suppkey, 'Polygon' kind, list_transform([[w, s], [w + 2, s], [w + 2, s + 1], [w, s + 1], [w, s]], lambda p: p[1]::varchar || ' ' || p[2]::varchar)[3] corner, 5 n_vertices
from (select s_suppkey, (s_suppkey % 30)::double s, (s_suppkey % 40)::double w from supplier) t""")
def bbox_polygon(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 30).cast("double").alias("s"), (F.col("s_suppkey") % 40).cast("double").alias("w"))
    p = s.withColumn("p", geo.polygon(geo.bbox_ring(F.col("s"), F.col("s") + 1, F.col("w"), F.col("w") + 2)))
    ring = F.get("p.coordinates", F.lit(0))
    return p.select("s_suppkey", F.col("p.type").alias("kind"), F.concat_ws(" ", F.get(F.get(ring, F.lit(2)), F.lit(0)).cast("string"), F.get(F.get(ring, F.lit(2)), F.lit(1)).cast("string")).alias("corner"), F.size(ring).alias("n_vertices"))
