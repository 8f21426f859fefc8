"""Registry of queries over the driver's tables and their SQL for DuckDB.

The tables hold no incidents, so stand-ins are used: documents are items,
events are timed events (user_id % 5 their country), suppliers are assets, and
orders' lines name candidates. Every query is over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


from emberlane.plans import assets, indexes, items, places, timed  # noqa: E402, F401
