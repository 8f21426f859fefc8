"""How events go together: daily counts per country, Pearson's correlation per
country, and the mean of its positive entries over countries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_counts(items: DataFrame, events: DataFrame) -> DataFrame:
    """country, day, event, n for every event on every day on which the country has
    an item. items: country, ts, event (a row per tag; null: an item without one);
    events: one column event, a fixed vocabulary."""
    days = items.select("country", F.to_date("ts").alias("day")).distinct()
    counts = items.where("event is not null").groupBy("country", F.to_date("ts").alias("day"), "event").agg(F.count("*").alias("n"))
    grid = days.crossJoin(events.select("event"))  # days by a vocabulary of fixed size
    return grid.join(counts, ["country", "day", "event"], "left").select("country", "day", "event", F.coalesce("n", F.lit(0)).alias("n"))


def _whole(c: Column) -> Column:
    return c.cast("decimal(18,0)")


def sums(daily: DataFrame) -> DataFrame:
    """country, event_a, event_b and, over its days, n, x, y, xx, yy, xy: how many, and
    the sums of counts, squares and products. A country's day holds each event of the
    vocabulary once, so the pairs of a day are a square of fixed size."""
    a = daily.select("country", "day", F.col("event").alias("event_a"), F.col("n").alias("x"))
    b = daily.select("country", "day", F.col("event").alias("event_b"), F.col("n").alias("y"))
    total = lambda c: _whole(F.sum(_whole(c)))
    return a.join(b, ["country", "day"]).groupBy("country", "event_a", "event_b").agg(
        _whole(F.count("*")).alias("n"), total(F.col("x")).alias("x"), total(F.col("y")).alias("y"),
        *[total(F.col(p) * F.col(q)).alias(p + q) for p, q in ("xx", "yy", "xy")],
    )


def of_sums(added: DataFrame) -> DataFrame:
    """country, event_a, event_b, corr (0 where a count is constant), clamped at 0.
    Counts are integers, so n**2 times the covariance and the variances are exact:
    what is zero is zero, whatever the order of sums, and only their quotient is a float."""
    spread = lambda p, q: F.col("n") * F.col(p + q) - F.col(p) * F.col(q)
    exact = added.select("country", "event_a", "event_b", spread("x", "y").alias("cov"), spread("x", "x").alias("vx"), spread("y", "y").alias("vy"))
    r = F.col("cov").cast("double") / (F.sqrt(F.col("vx").cast("double")) * F.sqrt(F.col("vy").cast("double")))
    return exact.select("country", "event_a", "event_b", F.when((F.col("cov") > 0) & (F.col("vx") > 0) & (F.col("vy") > 0), r).otherwise(F.lit(0.0)).alias("corr"))


def correlations(daily: DataFrame) -> DataFrame:
    """country, event_a, event_b, corr of daily counts."""
    return of_sums(sums(daily))


def positive_mean(corr: DataFrame) -> DataFrame:
    """event_a, event_b, corr: mean over the countries with a positive entry; 0 if none."""
    return corr.groupBy("event_a", "event_b").agg(F.coalesce(F.avg(F.when(F.col("corr") > 0, F.col("corr"))), F.lit(0.0)).alias("corr"))


def unpivoted(matrix: DataFrame, label: str) -> DataFrame:
    """A labelled square matrix as rows."""
    return matrix.unpivot([label], [c for c in matrix.columns if c != label], "event_b", "corr").withColumnRenamed(label, "event_a")


def pivoted(corr: DataFrame, events: list[str]) -> DataFrame:
    return corr.groupBy("event_a").pivot("event_b", events).agg(F.first("corr"))
