"""A table of what ran: a row for every stage of a run and every batch of a stream,
with rows in, rows out and seconds.

Rows are counted on the way, by observations of the DataFrames that are written anyway;
no stage is run twice for its figures.
"""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "run string, kind string, stage string, number long, at timestamp, seconds double, rows_in long, rows_out long, status string"


class RunLog(StreamingQueryListener):
    """Rows of one run, appended to the table at path by flush(), and when a stage or a
    stream ends. Added as a listener (spark.streams.addListener), it takes the batches
    of every stream."""

    def __init__(self, spark: SparkSession, path: str, run: str | None = None):
        super().__init__()
        self.spark, self.path, self.run, self._rows = spark, path, run or uuid.uuid4().hex, []

    def add(self, kind: str, stage: str, number: int | None, begun: float, seconds: float, rows_in: int | None, rows_out: int | None, status: str = "ok") -> None:
        self._rows.append((self.run, kind, stage, number, begun, seconds, rows_in, rows_out, status))

    @contextlib.contextmanager
    def stage(self, name: str) -> Iterator[Counted]:
        """Inside, counted.read() and counted.written() mark the stage's DataFrames."""
        counted, begun = Counted(), time.time()
        status = "failed"
        try:
            yield counted
            status = "ok"
        finally:
            ended = status == "ok"
            self.add("stage", name, None, begun, time.time() - begun, counted.total("in") if ended else None, counted.total("out") if ended else None, status)
            self.flush()

    def flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            times = self.spark.createDataFrame([r[:4] + r[5:] + (r[4],) for r in rows], SCHEMA.replace(" at timestamp,", "") + ", _at double")
            times.withColumn("at", F.timestamp_seconds("_at")).select(*[c.split()[0] for c in SCHEMA.split(", ")]).coalesce(1).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.numInputRows:
            out = p.sink.numOutputRows
            seconds = p.durationMs.get("triggerExecution", 0) / 1000
            self.add("batch", p.name or str(p.id), p.batchId, time.time() - seconds, seconds, p.numInputRows, out if out >= 0 else None)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.add("stream", str(event.id), None, time.time(), 0.0, None, None, "failed")


class Counted:
    """Counts of a stage's rows, taken while they pass."""

    def __init__(self) -> None:
        self._seen: dict[str, list[Observation]] = {"in": [], "out": []}

    def _observed(self, df: DataFrame, side: str) -> DataFrame:
        o = Observation(f"rows-{side}-{uuid.uuid4().hex}")
        self._seen[side].append(o)
        return df.observe(o, F.count(F.lit(1)).alias("n"))

    def read(self, df: DataFrame) -> DataFrame:
        """To be used in one action of the stage, once."""
        return self._observed(df, "in")

    def written(self, df: DataFrame) -> DataFrame:
        return self._observed(df, "out")

    def total(self, side: str) -> int | None:
        return sum(o.get["n"] for o in self._seen[side]) if self._seen[side] else None
