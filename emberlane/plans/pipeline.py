"""The whole pipeline as composed DataFrames: tag, resolve, share, merge, cluster.

Nothing is written on the way; the caller writes what it wants to keep.
"""

from __future__ import annotations

import contextlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlane.config import Config
from emberlane.functions import text as X
from emberlane.operators import clusters, correlation, entities, gazetteer, merge, resolve, share, tagging
from emberlane.progress import RunLog
from emberlane.schemas import TAG

_tag = F.struct(F.col("id").cast("long").alias("id"), "initial", "match", "type")


def reset(items: DataFrame) -> DataFrame:
    """Items without derived columns' contents."""
    return items.withColumns({
        "geo_tags": F.array().cast(f"array<{TAG}>"), "owner_tags": F.array().cast(f"array<{TAG}>"), "ref_match": F.array().cast("array<struct<GeoAssetID:bigint,GeoAssetName:string,confidence:double>>"),
        "country_match": F.array().cast("array<struct<country:string,p:double>>"), "events_tags": F.array().cast("array<string>"),
    })


def tag(items: DataFrame, assets: DataFrame, owners: DataFrame, names: DataFrame, peoples: DataFrame, config: Config, texts: list[str], hashtags: str | None = None) -> DataFrame:
    """items (item, ts, texts) with geo_tags, owner_tags and events_tags.
    names: match, label, of places and peoples."""
    fresh = items.where(F.col("ts") >= F.lit(config.start).cast("timestamp_ntz"))
    refs = tagging.refname_tags(fresh, gazetteer.asset_names(assets), texts)
    cities = tagging.city_tags(fresh, gazetteer.city_names(assets), texts)
    found = entities.places(entities.by_gazetteer(fresh, names, texts), peoples).select("item", F.lit(None).cast("long").alias("id"), "initial", "match", F.lit("GPE").alias("type"))
    if hashtags:
        split = entities.hashtag_places(fresh, hashtags)
        found = found.unionByName(split.select("item", F.lit(None).cast("long").alias("id"), F.col("match").alias("initial"), "match", F.lit("GPE").alias("type"))).dropDuplicates(["item", "match"])
    owned = tagging.owner_tags(fresh, gazetteer.owner_names(owners), texts)
    spark = items.sparkSession
    words = spark.createDataFrame([(w,) for w in (*config.event_words, *(config.event_hashtags if hashtags else ()))], "match string").distinct()
    events = tagging.event_tags(fresh, words, texts, hashtags)
    out = tagging.collected(fresh, refs.unionByName(cities).unionByName(found), "geo_tags", _tag)
    out = tagging.collected(out, owned, "owner_tags", _tag).withColumn("owner_tags", tagging.without_overlaps(F.col("owner_tags")))
    return tagging.collected(out, events, "events_tags", F.col("match"))


def match(tagged: DataFrame, assets: DataFrame, countries: DataFrame, gpes: DataFrame | None, config: Config) -> DataFrame:
    """tagged with ref_match and country_match. countries: GeoAssetID, country."""
    tags = tagged.select("item", F.explode(F.concat("geo_tags", "owner_tags")).alias("t")).select("item", "t.id", "t.type", "t.match")
    places = resolve.known_places(tags.where("type = 'GPE'").select("item", F.col("match").alias("name")).distinct(), gpes) if gpes is not None else None
    shapes = resolve.known_shapes(gpes) if gpes is not None else None
    rows = assets.select(F.col("GeoAssetID").alias("id"), F.col("GeoAssetName").alias("name"), F.col("FromDate").alias("begin"), F.col("ToDate").alias("end"), F.col("Longitude").alias("lon"), F.col("Latitude").alias("lat"))
    found = resolve.resolve(tagged.select("item", "ts"), tags.select("item", "id", "type"), rows, places, config.as_of, shapes).select("item", "ref_match")
    out = tagged.drop("ref_match").join(found, "item", "left")
    out = out.withColumn("ref_match", F.coalesce("ref_match", F.array().cast(dict(found.dtypes)["ref_match"])))
    each = found.select("item", F.explode("ref_match.GeoAssetID").alias("GeoAssetID")).join(countries, "GeoAssetID", "left")
    return out.drop("country_match").join(share.country_shares(each), "item", "left")


def correlation_of(items: DataFrame, events: list[str]) -> DataFrame:
    """The events' correlation over items (country_match, ts, events_tags) that are certain of their country."""
    sure = items.where(F.get("country_match", F.lit(0))["p"] == 1).select(F.get("country_match", F.lit(0))["country"].alias("country"), "ts", F.explode_outer("events_tags").alias("event"))
    vocabulary = items.sparkSession.createDataFrame([(e,) for e in events], "event string")
    return correlation.positive_mean(correlation.correlations(correlation.daily_counts(sure, vocabulary)))


def cluster(items: DataFrame, corr: dict[tuple[str, str], float], config: Config) -> DataFrame:
    """cluster_id and ref_match_cl of items (item, ts, country_match, ref_match, events_tags)."""
    c = config.clustering
    ready = items.where(F.exists("country_match", lambda x: x["p"] > 0.5)).select(
        "item", "ts", share.top_country(F.col("country_match")).alias("country"), F.sort_array(F.transform("ref_match", lambda r: r["GeoAssetID"])).alias("ids"), F.col("events_tags").alias("events")
    )
    return clusters.clustered(ready, corr, f"{c.time_threshold_days * 86400} seconds", c.no_split_days * 86400, c.correlation_threshold, c.subsplit_min_size, c.subsplit)


_iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def posts(raw: DataFrame) -> DataFrame:
    """Raw posts as items: item, ts, hashtags, and created_at as an ISO time."""
    items = raw.select("*", F.col("id").alias("item"), X.post_time(F.col("created_at")).alias("ts"), F.transform("entities.hashtags", lambda h: h["text"]).alias("hashtags"))
    return items.withColumn("created_at", _iso)


def headlines(raw: DataFrame) -> DataFrame:
    items = raw.select("*", F.col("storyId").alias("item"), X.post_time(F.col("firstCreated")).alias("ts"))
    return items.withColumn("firstCreated", _iso)


def merged(posts_done: DataFrame, headlines_done: DataFrame) -> DataFrame:
    return merge.merged(merge.posts_as_items(posts_done), merge.headlines_as_items(headlines_done))


def run(tables: dict[str, DataFrame], config: Config, folder: str, matrix: dict[tuple[str, str], float] | None = None, log: RunLog | None = None) -> DataFrame:
    """Merged items with cluster_id and ref_match_cl. tables: posts, headlines,
    assets, owners, names, peoples, countries and, if known, gpes. The tagged and
    the merged items are written below folder, so later stages read tables and do
    not plan the earlier ones again. Without a matrix of event correlations one is
    learned from the items; it is a vocabulary's square, and its cells are all that
    comes to the driver. With a log, each stage leaves a row in it."""
    spark = tables["posts"].sparkSession

    def stage(name: str, df: DataFrame) -> DataFrame:
        with log.stage(name) if log else contextlib.nullcontext() as counted:
            (counted.written(df) if counted else df).write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    dims = [tables[k] for k in ("assets", "owners", "names", "peoples")]
    done = []
    for name, items, texts, hashtags in (("posts", posts(tables["posts"]), ["full_text"], "hashtags"), ("headlines", headlines(tables["headlines"]), ["text", "snippet"], None)):
        tagged = stage(f"tagged-{name}", tag(reset(items), *dims, config, texts, hashtags))
        done.append(stage(f"matched-{name}", match(tagged, tables["assets"], tables["countries"], tables.get("gpes"), config)))
    items = stage("merged", merged(*done))
    ready = items.withColumn("item", F.col("id")).withColumn("ts", X.post_time(F.col("created_at")))
    if matrix is None:
        events = sorted({*config.event_words, *config.event_hashtags})
        matrix = {(r["event_a"], r["event_b"]): r["corr"] for r in correlation_of(ready, events).where("corr > 0").collect()}
    return items.drop("cluster_id").join(cluster(ready, matrix, config).withColumnRenamed("item", "id"), "id", "left")
