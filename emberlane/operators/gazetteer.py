"""Gazetteers: the spellings by which assets, cities and owners are looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from emberlane.functions import text as X


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first by an order that names it; nulls are equal."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _spelled(df: DataFrame, name: str, spellings: Column, kind: str, by: list[str]) -> DataFrame:
    out = df.select(F.col("GeoAssetID").alias("id"), F.col(name).alias("initial"), F.explode(spellings).alias("match")).where("match is not null").where(~F.col("match").isin("", "nan"))
    return keep_first(out, by, [F.col("id"), F.col("initial")]).select("id", "initial", "match", F.lit(kind).alias("type"))


def asset_names(assets: DataFrame) -> DataFrame:
    """Each distinct name is credited to the first id that carries it."""
    first = keep_first(assets, ["GeoAssetName"], [F.col("GeoAssetID")])
    return _spelled(first, "GeoAssetName", X.name_variants(F.col("GeoAssetName")), "refname", ["initial", "match"])


def city_names(assets: DataFrame) -> DataFrame:
    cities = assets.where("City is not null").dropDuplicates(["GeoAssetID", "City"])
    return _spelled(cities, "City", X.city_variants(F.col("City")), "cityname", ["id", "match"])


def owner_names(owners: DataFrame) -> DataFrame:
    known = owners.withColumn("CompanyName", F.nullif("CompanyName", F.lit("Unknown"))).where("CompanyName is not null").dropDuplicates(["GeoAssetID", "CompanyName"])
    return _spelled(known, "CompanyName", X.owner_variants(F.col("CompanyName")), "ownername", ["id", "match"])


def new_ids(listed: DataFrame, known: DataFrame, again: DataFrame, key: str = "GeoAssetID") -> DataFrame:
    """Ids that are listed and not yet known, and those to be done again."""
    return listed.select(key).distinct().join(known.select(key), key, "left_anti").unionByName(again.select(key)).distinct()
