"""Entity resolution: tags of an item to assets valid at its time.

Every stage narrows the candidates in its own way; the answer is the smallest
set that is not empty, of equals that of the earliest stage. So all stages are
rows of one relation, counted and ranked per item. Sets that many items share (all
assets of a town, of an owner, or in a polygon) are counted once for all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlane.functions import geo
from emberlane.functions.text import confidence
from emberlane.operators.places import covering, within
from emberlane.session import materialize


TOGETHER = 500  # items that a task gives a shared answer to


def _since(begin: Column) -> Column:
    return F.coalesce(begin, F.lit("1800-01-01").cast("timestamp_ntz"))


def _until(end: Column, as_of: Column) -> Column:
    return F.coalesce(end, as_of.cast("date").cast("timestamp_ntz"))


def valid(ts: Column, begin: Column, end: Column, as_of: Column) -> Column:
    """Inclusive at both ends; no begin: since 1800; no end: until midnight of as_of."""
    return (_since(begin) <= ts) & (_until(end, as_of) >= ts)


def grouped(groups: DataFrame, members: DataFrame) -> DataFrame:
    """(item, cities, owners): the groups that an item is tagged with, as sorted arrays;
    groups without a member are none."""
    known = groups.join(members.where("id is not null").select("group").distinct(), "group", "left_semi")
    of = lambda t: F.sort_array(F.collect_set(F.when(F.col("type") == t, F.col("group"))))
    return known.groupBy("item").agg(of("cityname").alias("cities"), of("ownername").alias("owners"))


def _spread(tags: DataFrame, groups: DataFrame, members: DataFrame) -> DataFrame:
    """tags with the members of those groups that stages need one by one: of cities, of
    items without refname, and of owners, of items that are tagged with other owners."""
    has = lambda t: tags.where(F.col("type") == t).select("item").distinct()
    of = lambda t: groups.where(F.col("type") == t)
    needed = of("cityname").join(has("refname"), "item", "left_anti").unionByName(of("ownername").join(has("ownername"), "item", "left_semi"))
    return tags.unionByName(needed.join(members.where("id is not null"), "group").select("item", "id", "type"))


def flags(tags: DataFrame, groups: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """Per (item, id): of which types it is tagged, and which types the item has at all.
    groups (item, group, type: cityname or ownername) stand for tags with each of their
    members (group, id), but are not written out: an item's tags look up whether they
    are among them. whole: all the item's owners are groups; what is only in these has
    no row."""
    by = Window.partitionBy("item")
    is_ = lambda t: F.max(F.col("type") == t)
    tags = tags.where("id is not null").select("item", "id", "type")
    spread = tags if groups is None else _spread(tags, groups, members)
    per = spread.groupBy("item", "id").agg(is_("refname").alias("ref"), is_("cityname").alias("city"), is_("ownername").alias("owner"))
    more = {"ref": F.lit(False), "city": F.lit(False), "owner": F.lit(False)}
    per = per.withColumn("whole", F.lit(False))
    if groups is not None:
        mine = members.where("id is not null").groupBy("id").agg(F.collect_set("group").alias("_in"))
        per = per.join(mine, "id", "left").join(grouped(groups, members), "item", "left")
        among = lambda t: F.coalesce(F.arrays_overlap("_in", t), F.lit(False))
        per = per.withColumn("_direct", F.col("owner")).withColumns({"city": F.col("city") | among("cities"), "owner": F.col("owner") | among("owners")})
        more |= {"city": F.coalesce(F.size("cities") > 0, F.lit(False)), "owner": F.coalesce(F.size("owners") > 0, F.lit(False))}
    any_ = lambda c: F.max(c).over(by)  # noqa: E731  # all over one window
    has = per.withColumns({"_ref": any_(F.col("ref")), "_city": any_(F.col("city")), "_owner": any_(F.col("owner")), "_both": any_(F.col("ref") & F.col("city"))} | ({} if groups is None else {"_own": any_(F.col("_direct"))}))
    if groups is not None:
        has = has.withColumn("whole", more["owner"] & ~F.col("_own"))
    has = has.withColumns({f"has_{t}": F.col(f"_{t}") | m for t, m in more.items()})
    comb = (F.col("ref") | F.col("city")) & (F.col("ref") | ~F.col("has_ref")) & (F.col("city") | ~F.col("has_city"))
    # whether any row has comb
    has_comb = F.when(F.col("has_ref") & F.col("has_city"), F.col("_both")).when(F.col("has_ref"), F.col("_ref")).otherwise(F.col("_city"))
    return has.select("item", "id", "ref", "city", "owner", "whole", "has_ref", "has_city", "has_owner", comb.alias("comb"), has_comb.alias("has_comb"))


def smallest(rows: DataFrame) -> DataFrame:
    """item, stage, base, poly, n (it counts rows of the asset table), found: the smallest
    of an item's sets that need no geometry, without those of asked(). rows: of flags(),
    with the name, of assets that are valid."""
    owner = F.when(F.col("has_comb"), F.col("comb") & F.col("owner")).otherwise(F.col("owner") & ~F.col("whole"))
    sets = [F.col("ref"), F.col("comb"), F.col("has_owner") & owner]
    kept = rows.select("item", "id", "name", F.array(*sets).alias("_in")).where(F.exists("_in", lambda x: x))
    per = kept.groupBy("item").agg(F.collect_list(F.struct("id", "name", "_in")).alias("_all"), *[F.count_if(F.get("_in", F.lit(i))).alias(f"_n{i}") for i in range(3)])
    sizes = F.array(*[F.struct(F.col(f"_n{i}").alias("n"), F.lit(i + 1).alias("stage")) for i in range(3)])
    best = per.select("item", "_all", F.array_min(F.filter(sizes, lambda x: x["n"] > 0)).alias("_best")).select("item", "_all", "_best.*")
    found = F.sort_array(F.transform(F.filter("_all", lambda x: F.element_at(x["_in"], F.col("stage"))), lambda x: F.struct(x["id"].alias("id"), x["name"].alias("name"))))
    return best.select("item", "stage", F.lit(0).alias("base"), F.lit(0).alias("poly"), "n", found.alias("found"))


def normal(places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item, place, shape) and (shape, polygons) of places that carry their polygons
    (or rings, those of one polygon): equal ones, by two 64-bit hashes, are one shape."""
    whole = places if "polygons" in places.columns else places.withColumn("polygons", F.array("rings"))
    keyed = whole.withColumn("shape", F.struct(F.xxhash64("polygons").alias("h"), F.xxhash64(F.lit(1), "polygons").alias("g")))
    return keyed.select("item", "place", "shape"), keyed.groupBy("shape").agg(F.first("polygons").alias("polygons"))


def contents(shapes: DataFrame, assets: DataFrame) -> DataFrame:
    """(shape, id): assets whose point lies in any of a shape's polygons. Polygons are
    covered by cells, and points meet cells: every polygon is looked at once, however
    many items name it, and its points are dealt by cell."""
    cells = materialize(covering(shapes), "covering")  # found once for all points
    points = assets.where("lon is not null and lat is not null").select("id", "lon", "lat").distinct()
    return within(cells, points).select("shape", "id").distinct()


def ranked(links: DataFrame, shapes: DataFrame) -> DataFrame:
    """(item, poly, shape): an item's places by their polygons' area, the largest first."""
    areas = shapes.select("shape", geo.multipolygon_area(F.col("polygons")).alias("_area"))
    return links.join(areas, "shape").withColumn("poly", F.row_number().over(Window.partitionBy("item").orderBy(F.col("_area").desc(), F.col("place")))).select("item", "poly", "shape")


def in_places(places: DataFrame, assets: DataFrame, shapes: DataFrame | None = None) -> DataFrame:
    """(item, poly, id): assets whose point lies in an item's place."""
    links, shapes = (places, shapes) if shapes is not None else normal(places)
    return ranked(links, shapes).join(contents(shapes, assets), "shape").select("item", "poly", "id").distinct()


def placed(flagged: DataFrame, order: DataFrame, held: DataFrame) -> DataFrame:
    """The candidate sets of polygons, from ranked() and contents(), of items with
    refname or owner tags: refname, owner, and both; they look only their own
    candidates up. Without those of asked()."""
    poly = lambda n, on: F.when(on, F.struct(F.lit(4).alias("stage"), F.lit(n).alias("base"), F.col("poly").alias("poly")))
    own = flagged.where("ref or owner").select("item", "id", "ref", "owner", "whole").join(order, "item").join(held, ["shape", "id"])
    sets = F.array_compact(F.array(poly(1, F.col("ref")), poly(2, F.col("owner") & ~F.col("whole")), poly(3, F.col("ref") & F.col("owner"))))
    return own.select("item", "id", F.inline(sets))


def asked(flagged: DataFrame, owners: DataFrame | None, order: DataFrame | None, items: DataFrame) -> DataFrame:
    """(item, stage, base, poly, owners, shape, ts): the candidate sets that items share:
    all of some groups of owners, of what lies in a polygon, or of both."""
    at = lambda d, stage, base: d.withColumns({"stage": F.lit(stage), "base": F.lit(base)}).select("item", "stage", "base", "poly", "owners", "shape")
    out = []
    shape = F.lit(None).cast("int" if order is None else order.schema["shape"].dataType)
    if owners is not None:
        alone = owners.join(flagged.where("comb").select("item").distinct(), "item", "left_anti")
        out.append(at(alone.withColumns({"poly": F.lit(0), "shape": shape}), 3, 0))
    if order is not None:
        tagged = flagged.where("has_ref or has_owner").select("item")
        if owners is not None:
            out.append(at(owners.join(order, "item"), 4, 2))
            tagged = tagged.unionByName(owners.select("item"))
        free = order.join(tagged.distinct(), "item", "left_anti")
        out.append(at(free.withColumn("owners", F.lit(None).cast("array<string>")), 4, 0))
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole.join(items.select("item", "ts"), "item")


def shared(asks: DataFrame, members: DataFrame | None, held: DataFrame | None, assets: DataFrame) -> DataFrame:
    """(key, begin, end, n, found): the assets of each set of owners and shape that
    asked() tells (key), those of one validity together."""
    kinds = asks.select("key", "owners", "shape").distinct()
    rows = assets.select("id", "name", "begin", "end")
    ids = None
    if members is not None:
        one = kinds.where("owners is not null").select("key", "shape", F.explode("owners").alias("group"))
        own = one.join(members, "group").select("key", "shape", "id").distinct()
        ids = own.where("shape is null").select("key", "id")
        if held is not None:
            ids = ids.unionByName(own.join(held, ["shape", "id"]).select("key", "id"))
    if held is not None:
        free = kinds.where("owners is null").select("key", "shape").join(held, "shape").select("key", "id")
        ids = free if ids is None else ids.unionByName(free)
    return ids.join(rows, "id").groupBy("key", "begin", "end").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("id", "name"))).alias("found"))


def resolve(items: DataFrame, tags: DataFrame, assets: DataFrame, places: DataFrame | None = None, as_of: str | None = None, shapes: DataFrame | None = None, groups: DataFrame | None = None, members: DataFrame | None = None, tell: Callable[[Column], dict[str, Column]] = lambda ref: {"ref_match": ref}) -> DataFrame:
    """item, stage, n, ref_match (array, by id), or what tell makes of it. items: item, ts; tags: item, id,
    type; assets: id, name, begin, end (lon, lat); places: item, place, shape, with
    shapes: shape, polygons; without shapes, places carry polygons or rings. groups
    and members as of flags(). A set that items share is counted once for each time
    that they ask for, by periods of validity. Where it is the answer it is put together
    and told once for all times at which the same assets are valid (as many have begun,
    and as many have ended), and only what is told of it goes to the items."""
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    now = valid(F.col("ts"), F.col("begin"), F.col("end"), today)
    flagged = flags(tags, groups, members)
    if places is None and groups is None:
        return _told(smallest(_rows(flagged, items, assets, now)), tell)
    flagged = materialize(flagged, "flagged")  # read several times
    by_row, order, held, owners = smallest(_rows(flagged, items, assets, now)), None, None, None
    if places is not None:
        links, shapes = (places, shapes) if shapes is not None else normal(places)
        order, held = ranked(links, shapes), materialize(contents(shapes, assets), "contents")
        by_row = by_row.unionByName(_counted(placed(flagged, order, held), items, assets, now))
    if groups is not None:
        direct = tags.where("id is not null and type = 'ownername'").select("item").distinct()
        owners = grouped(groups, members).where(F.size("owners") > 0).select("item", "owners").join(direct, "item", "left_anti")
    asks = materialize(asked(flagged, owners, order, items).withColumn("key", F.to_json(F.struct("owners", "shape"))), "asked")
    pieces = materialize(shared(asks, members, held, assets), "shared")
    begun, ended = _since(F.col("begin")) <= F.col("ts"), _until(F.col("end"), today) < F.col("ts")
    sums = [F.sum(F.when(now, F.col("n"))).alias("n"), F.count_if(begun).alias("begun"), F.count_if(ended).alias("ended")]
    counts = asks.select("key", "ts").distinct().join(pieces.select("key", "begin", "end", "n"), "key").groupBy("key", "ts").agg(*sums).where("n > 0")
    empty = F.lit(None).cast(pieces.schema["found"].dataType)
    by_row = by_row.withColumns({"key": F.lit(None).cast("string"), "ts": F.lit(None).cast(items.schema["ts"].dataType), "begun": F.lit(0).cast("long"), "ended": F.lit(0).cast("long")})
    by_key = asks.join(counts, ["key", "ts"]).withColumn("found", empty).select(*by_row.columns)
    first = materialize(_first(by_row.unionByName(by_key), ["stage", "n", "found", "key", "ts", "begun", "ended"]), "first")
    direct = _told(first.where("key is null").select("item", "stage", "n", "found"), tell)
    return direct.unionByName(_dealt(first.where("key is not null").drop("found"), pieces.drop("n"), now, tell))


def _dealt(late: DataFrame, pieces: DataFrame, now: Column, tell: Callable[[Column], dict[str, Column]]) -> DataFrame:
    """item, stage, n and what is told of the set of assets that is an item's answer.
    A set that many items share goes to as many tasks, since they write it out as often."""
    same = ["key", "begun", "ended"]
    sets = late.groupBy(*same).agg(F.min("ts").alias("ts"), F.max("n").alias("n"), F.ceil(F.count("*") / TOGETHER).alias("_parts"))
    found = sets.join(pieces, "key").where(now).groupBy(*same, "n", "_parts").agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    told = found.select(*same, "n", "_parts", *[c.alias(k) for k, c in tell(_ref()).items()])
    lists = told.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("n", "_parts")
    parts = late.join(sets.select(*same, "_parts"), same).withColumn("_part", F.pmod(F.xxhash64("item"), F.col("_parts"))).select("item", "stage", "n", *same, "_part")
    # so many partitions whatever they hold: rows are short here and long afterwards
    count = int(late.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(count, *same, "_part").join(lists, [*same, "_part"]).drop(*same, "_part")


def _rows(sets: DataFrame, items: DataFrame, assets: DataFrame, now: Column) -> DataFrame:
    return sets.join(items.select("item", "ts"), "item").join(assets.select("id", "name", "begin", "end"), "id").where(now)


def _counted(sets: DataFrame, items: DataFrame, assets: DataFrame, now: Column) -> DataFrame:
    """n (it counts rows of the asset table) and found of each item's sets."""
    return _rows(sets, items, assets, now).groupBy("item", "stage", "base", "poly").agg(F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("id", "name"))).alias("found"))


def _first(per: DataFrame, columns: list[str]) -> DataFrame:
    best = Window.partitionBy("item").orderBy("n", "stage", "base", "poly")
    return per.withColumn("_r", F.row_number().over(best)).where("_r = 1").select("item", *columns)


def _ref() -> Column:
    return F.transform("found", lambda x: F.struct(x["id"].alias("GeoAssetID"), x["name"].alias("GeoAssetName"), confidence(F.col("n")).alias("confidence")))


def _told(first: DataFrame, tell: Callable[[Column], dict[str, Column]]) -> DataFrame:
    return first.select("item", "stage", "n", *[c.alias(k) for k, c in tell(_ref()).items()])


def in_all_types(tags: DataFrame, groups: DataFrame | None = None, members: DataFrame | None = None) -> DataFrame:
    """(item, id) that every present type of refname and cityname has."""
    if groups is not None:
        groups = groups.where("type = 'cityname'")
    return flags(tags.where(F.col("type").isin("refname", "cityname")), groups, members).where("comb").select("item", "id")


def areas_of(gpes: DataFrame) -> DataFrame:
    """Gazetteer entries that are areas."""
    return gpes.where(~F.col("boundaries.type").isin("Point", "LineString", "MultiLineString"))


def known_places(names: DataFrame, gpes: DataFrame) -> DataFrame:
    """(item, place, shape) of the areas that carry a name, the more important first
    in place's order. names: item, name. Polygons stay in known_shapes()."""
    areas = areas_of(gpes).select(F.struct((-F.col("importance")).alias("by"), "place_id").alias("place"), F.col("place_id").alias("shape"), F.explode("GPEs").alias("name"))
    return names.join(areas, "name").select("item", "place", "shape")


def known_shapes(gpes: DataFrame) -> DataFrame:
    """(shape, polygons) of the gazetteer's areas."""
    polygons = geo.polygons(F.col("boundaries.type"), F.col("boundaries.coordinates"), dict(gpes.select("boundaries.coordinates").dtypes)["coordinates"])
    return areas_of(gpes).select(F.col("place_id").alias("shape"), polygons.alias("polygons")).dropDuplicates(["shape"])
