"""A table in which every key is written once, whatever fails or is repeated.

A batch is staged as files of its own, dealt into buckets by key, and counts once a new
state of the table is published that names them (sources.versions): together with the
number of the batch, so that a batch that is replayed changes nothing, and after all
that was published before, so that of two writers the second looks again at what the
first has added. Files that no state names are never read.

Keys are looked up by bucket: each batch's files have the hashes of its keys beside
them, and only those of the buckets that the new keys fall into are read; the few keys
whose hash is there are then compared. Rows are not read, and nothing of the table's
size is shuffled.

Defined cases: rows without a key are left out; of rows that repeat a key in one batch
the first by all columns stays; an empty batch is published as a number alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlane.operators.gazetteer import keep_first
from emberlane.sources import versions

BUCKETS = 256


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def _hash(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """What the latest state holds; None before the first, unless a schema is given."""
    parts = versions.latest(spark, path)[1].get("parts", [])
    if not parts:
        return spark.createDataFrame([], schema) if schema else None
    return spark.read.parquet(*[f"{path}/rows/{p}" for p in parts])


def _present(spark: SparkSession, path: str, parts: list[str], new: DataFrame, key: str) -> DataFrame | None:
    """Keys of new (with _h and _b) that the parts hold."""
    touched = [r["_b"] for r in new.select("_b").distinct().collect()]  # BUCKETS at most
    if not parts or not touched:
        return None
    at = f"{path}/keys"
    known = spark.read.schema("h long, k string, part string, b int").option("basePath", at).parquet(*[f"{at}/part={p}" for p in parts]).where(F.col("b").isin(touched))
    return new.select(key, "_h").join(known.select(F.col("h").alias("_h"), F.col("k").alias("_k")), "_h").where(F.col("_k") == F.col(key).cast("string")).select(key).distinct()


def write(batch: DataFrame, path: str, key: str, writer: str, number: int) -> bool:
    """Adds the rows whose key the table does not have; False if the writer's batch of
    this number (or a later one) is in already."""
    spark = batch.sparkSession
    mine = batch.where(F.col(key).isNotNull()).withColumn("_h", _hash(key)).withColumn("_b", _bucket(F.col("_h")))
    order = [F.to_json(F.struct(*batch.columns))]
    one = keep_first(mine, [key], order).persist()
    try:
        while True:
            version, state = versions.latest(spark, path)
            if state.get("batches", {}).get(writer, -1) >= number:
                return False
            parts = state.get("parts", [])
            known = _present(spark, path, parts, one, key)
            fresh = one if known is None else one.join(known, key, "left_anti")
            part = uuid.uuid4().hex
            stage(fresh, path, part, key, batch.columns)
            try:
                versions.publish(spark, path, version + 1, {"parts": [*parts, part], "batches": {**state.get("batches", {}), writer: number}})
                return True
            except versions.Conflict:
                _drop(spark, path, part)  # another writer was first: look again
    finally:
        one.unpersist()


def stage(rows: DataFrame, path: str, part: str, key: str, columns: list[str]) -> None:
    """Writes rows (with _h and _b), and their keys by bucket."""
    rows.select(*columns).write.parquet(f"{path}/rows/{part}")
    rows.select(F.col("_b").alias("b"), F.col("_h").alias("h"), F.col(key).cast("string").alias("k")).repartition("b").sortWithinPartitions("b", "h").write.partitionBy("b").parquet(f"{path}/keys/part={part}")


def _drop(spark: SparkSession, path: str, part: str) -> None:
    for at in (f"{path}/rows/{part}", f"{path}/keys/part={part}"):
        folder = spark._jvm.org.apache.hadoop.fs.Path(at)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def compacted(spark: SparkSession, path: str, key: str) -> None:
    """Merges the parts there are into one; parts added meanwhile stay."""
    parts = versions.latest(spark, path)[1].get("parts", [])
    if len(parts) < 2:
        return
    rows = table(spark, path)
    part = uuid.uuid4().hex
    stage(rows.withColumn("_h", _hash(key)).withColumn("_b", _bucket(F.col("_h"))), path, part, key, rows.columns)

    def change(state: dict) -> dict | None:
        now = state["parts"]
        return {**state, "parts": [part, *now[len(parts) :]]} if now[: len(parts)] == parts else None

    versions.commit(spark, path, change)
