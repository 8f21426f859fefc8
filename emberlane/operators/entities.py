"""Entity extraction: places and peoples named in texts.

An extractor gives (item, text, label) with label GPE or NORP. The default looks
names up in a gazetteer; a tagger that was trained on what a gazetteer or people
labelled (operators.tagger), or any function over pandas frames, can be put in its
place. What follows extraction is the same for all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlane.functions import text as X
from emberlane.operators.tagger import Tagger, tagged
from emberlane.operators.tagging import whole_words
from emberlane.session import ship


def by_gazetteer(items: DataFrame, names: DataFrame, texts: list[str]) -> DataFrame:
    """names: match, label."""
    return whole_words(items, names, texts).select("item", F.col("match").alias("text"), "label").distinct()


def by_tagger(items: DataFrame, model: Tagger) -> DataFrame:
    """items: item, text."""
    return tagged(items, model).distinct()


def by_model(items: DataFrame, model: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> DataFrame:
    """model takes and gives frames, a batch at a time: item, text in; item, text, label out."""
    ship(items.sparkSession)
    kind = dict(items.dtypes)["item"]
    return items.select("item", "text").mapInPandas(model, f"item {kind}, text string, label string").distinct()


def places(entities: DataFrame, peoples: DataFrame) -> DataFrame:
    """(item, match, initial): a text that is both place and people is a place; a
    people becomes its place if peoples (NORP, GPE) knows it. Distinct."""
    one = entities.groupBy("item", "text").agg(F.min("label").alias("label"))  # GPE sorts before NORP
    joined = one.join(peoples, (F.col("label") == "NORP") & (F.col("text") == F.col("NORP")), "left")
    return joined.select("item", F.col("text").alias("initial"), F.coalesce("GPE", "text").alias("match")).where(~F.col("match").startswith("http")).distinct()


def hashtag_places(items: DataFrame, hashtags: str) -> DataFrame:
    """(item, match) of camel-case hashtags, split."""
    each = items.select("item", F.explode(hashtags).alias("tag"))
    return each.select("item", X.camel_words(F.col("tag")).alias("match")).where(F.col("match").isNotNull() & ~F.col("match").startswith("http")).distinct()
