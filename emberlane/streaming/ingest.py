"""Streaming ingest of scraped pages, each post written once: pages as JSON files as
they land, or straight from a paged source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberlane.sources.files import posts_of, scraped
from emberlane.streaming import sink


def _started(bodies: DataFrame, target: str, checkpoint: str, writer: str) -> StreamingQuery:
    posts = posts_of(scraped(bodies)).where(F.col("id").isNotNull())

    def write(batch: DataFrame, number: int) -> None:
        sink.write(batch, target, "id", writer, number)

    return posts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest(spark: SparkSession, landing: str, target: str, checkpoint: str, writer: str | None = None) -> StreamingQuery:
    """Reads what lies in landing, to its end, and goes on from there next time. writer
    names the stream among those that write to target, by its checkpoint if not given."""
    bodies = spark.readStream.schema("search string, page int, body string").json(landing)
    return _started(bodies, target, checkpoint, writer or checkpoint)


def ingest_searches(spark: SparkSession, options: dict[str, str], target: str, checkpoint: str, writer: str | None = None) -> StreamingQuery:
    """Reads the pages that searches have had since last time (options of saved_posts)."""
    bodies = spark.readStream.format("saved_posts").options(**options).load()
    return _started(bodies, target, checkpoint, writer or checkpoint)
