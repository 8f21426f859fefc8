"""Sessions in time: a gap of the threshold or more begins a new one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def time_sessions(items: DataFrame, by: str, ts: str, item: str, gap: str) -> DataFrame:
    """items with session, from 1 in the order of time within by. Gaps are strict:
    items exactly gap apart are in two sessions. Rows are ordered hour by hour, so a
    value of by with a third of all rows is dealt over tasks; what is counted along
    the whole of by is a row per hour. An item without a time is a session alone."""
    keys = [by, "_day", "_hour"]
    split = lambda now, last: F.when(now - last < F.expr(f"interval {gap}"), 0).otherwise(1)
    w = Window.partitionBy(*keys).orderBy(ts, item)
    inner = F.when(F.row_number().over(w) == 1, 0).otherwise(split(F.col(ts), F.lag(ts).over(w)))
    marked = items.withColumns({"_day": F.to_date(ts), "_hour": F.hour(ts)}).withColumn("_new", inner)
    hours = marked.groupBy(*keys).agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.sum("_new").alias("_new"))
    along = Window.partitionBy(by).orderBy("_day", "_hour")
    opens = hours.withColumn("_opens", split(F.col("_first"), F.lag("_last").over(along)))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = opens.select(*[F.col(k).alias(f"_at{i}") for i, k in enumerate(keys)], (F.sum(F.col("_opens") + F.col("_new")).over(upto) - F.col("_new")).alias("_before"))
    same = [F.col(k).eqNullSafe(F.col(f"_at{i}")) for i, k in enumerate(keys)]
    inside = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return marked.withColumn("_inside", inside).join(before, same).select(*items.columns, (F.col("_before") + F.col("_inside")).alias("session"))


def near_in_time(items: DataFrame, by: list[str], ts: str, item: str, within: str) -> DataFrame:
    """(by, a, b) with a < b closer than within. Items meet by time bucket, each
    reaching its own bucket and the next, so that a pair is looked at once."""
    seconds = items.sparkSession.range(1).select(F.expr(f"cast(interval {within} as interval second)").cast("decimal(18,6)").alias("s")).first()["s"]
    width = max(int(float(seconds) * 1e6), 1)
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    bucket = F.floor(micros / width)
    left = items.select(*by, F.col(item).alias("a"), micros.alias("ta"), F.explode(F.array(bucket, bucket + 1)).alias("_bucket"), bucket.alias("_own"))
    right = items.select(*by, F.col(item).alias("b"), micros.alias("tb"), bucket.alias("_bucket"))
    close = (F.col("tb") - F.col("ta")).between(0, width - 1)
    once = (F.col("ta") < F.col("tb")) | (F.col("a") < F.col("b"))
    return left.join(right, [*by, "_bucket"]).where(close & once & (F.col("a") != F.col("b"))).select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
