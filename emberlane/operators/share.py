"""Countries of resolved items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.functions.text import share


def country_shares(matches: DataFrame) -> DataFrame:
    """item, country_match: share of each country among the item's matched assets,
    the largest first (ties by name). Assets without a country count in the whole.
    matches: item, country."""
    each = matches.groupBy("item", "country").agg(F.count("*").alias("n"))
    per = each.groupBy("item").agg(F.sum("n").alias("whole"), F.collect_list(F.when(F.col("country").isNotNull(), F.struct((-F.col("n")).alias("by"), "country", "n"))).alias("found"))
    return per.select("item", F.transform(F.sort_array("found"), lambda x: F.struct(x["country"].alias("country"), share(x["n"], F.col("whole")).alias("p"))).alias("country_match"))


def top_country(country_match: Column) -> Column:
    """The country of the largest share, the first of equals by name."""
    best = F.array_min(F.transform(country_match, lambda c: F.struct((-c["p"]).alias("by"), c["country"].alias("country"))))
    return best["country"]
