"""Merging of posts and headlines, and a sink in which the first write wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.operators.gazetteer import keep_first
from emberlane.schemas import MERGED


def complete(df: DataFrame) -> DataFrame:
    """Items with a match and an event."""
    full = lambda c: F.size(F.coalesce(F.col(c), F.array())) > 0
    return df.where(full("ref_match") & full("events_tags"))


def posts_as_items(posts: DataFrame) -> DataFrame:
    return complete(posts).withColumnsRenamed({"full_text": "text", "user_id_str": "source_id"}).drop("id").withColumnRenamed("id_str", "id")


def headlines_as_items(headlines: DataFrame) -> DataFrame:
    return complete(headlines).withColumnsRenamed({"storyId": "id", "firstCreated": "created_at", "sourceName": "source_id"})


def merged(first: DataFrame, second: DataFrame, columns: tuple[str, ...] = MERGED, same: tuple[str, ...] = ("created_at", "text", "snippet"), key: str = "id") -> DataFrame:
    """Both, in fixed columns, missing ones null; of items with equal same columns
    (nulls are equal) the one of first stays, then the smallest key."""
    both = first.withColumn("_from", F.lit(0)).unionByName(second.withColumn("_from", F.lit(1)), allowMissingColumns=True)
    for c in columns:
        if c not in both.columns:
            both = both.withColumn(c, F.lit(None).cast("string"))
    return keep_first(both, list(same), [F.col("_from"), F.col(key)]).select(*columns)


def insert_if_absent(new: DataFrame, target: DataFrame, key: str = "id", order: list[Column] | None = None) -> DataFrame:
    """The rows to append: of each new key one row, and none whose key the target has."""
    one = keep_first(new, [key], order or [F.col(c) for c in new.columns if c != key and "map" not in dict(new.dtypes)[c]])
    return one.join(target.select(key), key, "left_anti").select(*new.columns)
