"""Files: CSV tables with fixed schemas, results that are kept, labelled matrices, scraped pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane import schemas
from emberlane.operators.correlation import unpivoted


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def kept(spark: SparkSession, path: str, build: Callable[[], DataFrame], again: bool = False) -> DataFrame:
    """A table that is built and written once, and read after that."""
    if again or not exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def required(spark: SparkSession, path: str) -> str:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return path


def read_peoples(spark: SparkSession, path: str) -> DataFrame:
    """Peoples and their places, from a file in windows-1252: Spark's readers know
    only standard charsets, so the bytes are decoded by row."""
    raw = spark.read.format("binaryFile").load(required(spark, path)).select("content")

    def lines(batches):
        import csv
        import io

        import pandas as pd

        for df in batches:
            for content in df["content"]:
                rows = list(csv.DictReader(io.StringIO(bytes(content).decode("cp1252"))))
                yield pd.DataFrame({"NORP": [r["NORP"] for r in rows], "GPE": [r["GPE"] for r in rows]}, dtype="object")

    return raw.mapInPandas(lines, schemas.PLACE_OF_PEOPLE_CSV)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A labelled square matrix (labels in the first, unnamed column) as event_a, event_b, corr."""
    wide = spark.read.option("header", True).csv(path)
    label, *events = wide.columns
    return unpivoted(wide.select(label, *[F.col(f"`{e}`").cast("double").alias(e) for e in events]), label)


def scraped(bodies: DataFrame, body: str = "body") -> DataFrame:
    """status (ok, json_convert_failed, retry_clean) and posts of each response body."""
    parsed = F.from_json(body, schemas.SCRAPED)
    posts = F.map_values(F.col("_parsed.globalObjects.tweets"))
    broken = F.col("_parsed").isNull() | F.try_parse_json(body).isNull()
    status: Column = F.when(broken, "json_convert_failed").when(F.col("_parsed.globalObjects.tweets").isNull(), "retry_clean").otherwise("ok")
    return bodies.withColumn("_parsed", parsed).withColumn("status", status).withColumn("posts", posts).drop("_parsed")


def posts_of(pages: DataFrame) -> DataFrame:
    return pages.where("status = 'ok'").select(F.explode("posts").alias("post")).select("post.*")
