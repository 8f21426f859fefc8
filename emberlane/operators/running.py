"""Event correlation kept up to date: new items change it without the old being read.

Kept are, per country and day, how often each event of the vocabulary was counted, and
per country and pair of events the sums that Pearson's correlation is made of: days,
counts, squares and products. All of them add up over increments: an increment reads
the counts of the days that it touches, and appends the change of these and of the
sums. Sums are exact decimals, so the result equals that of the whole computation.

Counts and sums of an increment count together, once one state names both
(sources.versions); increments have a number per writer, so that one which is replayed
changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.operators import correlation
from emberlane.session import materialize
from emberlane.sources import versions

COUNTS = "country {0}, day date, event string, n long"
SUMS = "country {0}, event_a string, event_b string, n decimal(18,0), x decimal(18,0), y decimal(18,0), xx decimal(18,0), yy decimal(18,0), xy decimal(18,0)"


@dataclass(frozen=True)
class Running:
    """country is of one type, kind; events: the vocabulary, fixed from the first increment on."""

    spark: SparkSession
    path: str
    events: tuple[str, ...]
    kind: str = "string"

    def _read(self, part: str, schema: str, parts: list[str]) -> DataFrame:
        schema = schema.format(self.kind)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{part}/{p}" for p in parts]) if parts else self.spark.createDataFrame([], schema)

    def counts(self, parts: list[str] | None = None) -> DataFrame:
        """country, day, event, n of every day that had an item."""
        parts = versions.latest(self.spark, self.path)[1].get("parts", []) if parts is None else parts
        return self._read("counts", COUNTS, parts).groupBy("country", "day", "event").agg(F.sum("n").alias("n"))

    def correlations(self) -> DataFrame:
        """As correlation.correlations() over all increments."""
        parts = versions.latest(self.spark, self.path)[1].get("parts", [])
        names = ("n", "x", "y", "xx", "yy", "xy")
        sums = self._read("sums", SUMS, parts).groupBy("country", "event_a", "event_b").agg(*[F.sum(c).cast("decimal(18,0)").alias(c) for c in names])
        return correlation.of_sums(sums)

    def add(self, items: DataFrame, writer: str, number: int) -> bool:
        """Adds items (country, ts, event; a row per tag); False if that number is in."""
        words = self.spark.createDataFrame([(e,) for e in self.events], "event string")
        new = materialize(correlation.daily_counts(items.where("country is not null"), words), "increment")
        touched = new.select("country", "day").distinct()
        while True:
            version, state = versions.latest(self.spark, self.path)
            if state.get("batches", {}).get(writer, -1) >= number:
                return False
            parts = state.get("parts", [])
            old = materialize(self.counts(parts).join(touched, ["country", "day"], "left_semi"), "touched")
            now = new.unionByName(old).groupBy("country", "day", "event").agg(F.sum("n").alias("n"))
            part = uuid.uuid4().hex
            new.select("country", "day", "event", F.col("n").cast("long").alias("n")).write.parquet(f"{self.path}/counts/{part}")
            minus = correlation.sums(old)
            minus = minus.select("country", "event_a", "event_b", *[(-F.col(c)).cast("decimal(18,0)").alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
            change = correlation.sums(now).unionByName(minus).groupBy("country", "event_a", "event_b").agg(*[F.sum(c).cast("decimal(18,0)").alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
            change.write.parquet(f"{self.path}/sums/{part}")
            try:
                versions.publish(self.spark, self.path, version + 1, {"parts": [*parts, part], "batches": {**state.get("batches", {}), writer: number}})
                return True
            except versions.Conflict:
                continue  # what was written is named by no state
