"""Geocoding behind an interface: names to areas, points to addresses.

The results are a dimension table like any other; a provider is asked only for
names that the table does not have, a batch at a time.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlane.functions import geo
from emberlane.operators.places import nearest
from emberlane.session import materialize, ship
from emberlane.streaming import sink

PROBE = "Paris"  # a name any provider knows: if it is not found, the provider is down


class ServiceError(Exception):
    """The provider did answer, and refused: some do so when asked for all matches."""


class Geocoder(Protocol):
    def search(self, name: str, one: bool = False) -> list[dict]:
        """Matches of a name, or the best alone; OSError if the provider does not
        answer, ServiceError if it refuses."""

    def reverse(self, lat: float, lon: float) -> dict | None: ...


class Bucket:
    """A lane's share of a limit on requests: one every so many seconds. Waiting is not
    made up for later, so no second has more than its share."""

    def __init__(self, every: float, now: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.every, self.now, self.sleep = every, now, sleep
        self.free = now()

    def take(self) -> None:
        wait = self.free - self.now()
        if wait > 0:
            self.sleep(wait)
        self.free = max(self.free, self.now()) + self.every


def asked(coder: Geocoder, name: str, max_attempts: int = 10, wait_error: float = 5.0, wait: float = 0.5, bucket: Bucket | None = None) -> list[dict]:
    """Answers for a name. No answer is waited out and asked for again; a refusal is
    asked again at once for the best match alone, and if that fails too, waited out.
    After the last attempt, a name that the probe outlives has no answer, and else the
    provider's failure is raised."""
    bucket = bucket or Bucket(wait)

    def one(of: str, alone: bool) -> list[dict]:
        bucket.take()
        return coder.search(of, True) if alone else coder.search(of)

    for _ in range(max_attempts):
        try:
            return one(name, False)
        except OSError:
            bucket.sleep(wait_error)
        except ServiceError:
            try:
                return one(name, True)
            except (OSError, ServiceError):
                bucket.sleep(wait_error)
    try:
        if one(PROBE, True):
            return []
    except ServiceError:
        return []
    raise ConnectionError("the geocoder does not answer")


_ANSWER = "place_id: bigint, display_name: string, importance: double, geojson: string"
PLACES = "GPE string, place_id bigint, display_name string, importance double, geojson string"


def new_places(names: DataFrame, known: DataFrame, make: Callable[[], Geocoder], rate: float = 2.0, lanes: int = 1, **waits) -> DataFrame:
    """Answers for the names (name) that known (GPEs array) does not hold, at no more
    than rate requests a second in the whole cluster: the names are dealt to lanes, of
    which each is one task with its own share of the rate. A provider that is down
    fails its lane's task, and no other's answers are lost if the result is appended
    (appended_places)."""
    if names.sparkSession.conf.get("spark.speculation", "false") == "true":
        raise RuntimeError("a lane that runs twice would ask twice as often: spark.speculation must be off")
    missing = names.select("name").where("name is not null").distinct().join(known.select(F.explode("GPEs").alias("name")).distinct(), "name", "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder, bucket = make(), Bucket(lanes / rate)
        for df in batches:
            for n in df["name"]:  # given on as they come
                rows = [(n, r.get("place_id"), r.get("display_name"), r.get("importance"), r.get("geojson")) for r in asked(coder, n, bucket=bucket, **waits)]
                yield pd.DataFrame(rows, columns=["GPE", "place_id", "display_name", "importance", "geojson"])

    ship(names.sparkSession)
    return missing.repartition(lanes, "name").mapInPandas(run, PLACES)


def appended_places(names: DataFrame, path: str, make: Callable[[], Geocoder], batch: int = 1000, **more) -> None:
    """Asks for what the table of answers at path does not have, batch names at a time,
    each batch published when it is done: a run that stops goes on from there. A name
    without an answer is kept as one, with a null place, and not asked for again."""
    spark = names.sparkSession
    told = lambda: sink.table(spark, path, f"GPE string, answers array<struct<{_ANSWER}>>")
    while True:
        left = names.select("name").where("name is not null").distinct().join(told().select(F.col("GPE").alias("name")), "name", "left_anti").orderBy("name").limit(batch)
        some = materialize(left, "names")
        if some.isEmpty():
            return
        found = new_places(some, spark.createDataFrame([], "GPEs array<string>"), make, **more)
        per = found.groupBy(F.col("GPE").alias("name")).agg(F.collect_list(F.struct("place_id", "display_name", "importance", "geojson")).alias("answers"))
        empty = F.array().cast(f"array<struct<{_ANSWER}>>")
        rows = materialize(some.join(per, "name", "left").select(F.col("name").alias("GPE"), F.coalesce("answers", empty).alias("answers")), "answers")
        sink.write(rows, path, "GPE", uuid.uuid4().hex, 0)


def aliases(display_name: Column, name: Column) -> Column:
    """The names under which a place is found: its own head and the one asked for."""
    return F.array_distinct(F.array(F.btrim(F.split_part(display_name, F.lit(","), F.lit(1))), name))


def addressed(assets: DataFrame, make: Callable[[], Geocoder]) -> DataFrame:
    """GeoAssetID, country, bounding box of assets' points, by reverse geocoding."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = make()
        for df in batches:
            rows = []
            for i, lat, lon in zip(df["GeoAssetID"], df["Latitude"], df["Longitude"]):
                r = coder.reverse(lat, lon) or {}
                box = [float(x) for x in r.get("boundingbox") or []] or [None] * 4
                rows.append((i, r.get("country"), *box))
            yield pd.DataFrame(rows, columns=["GeoAssetID", "country", "south", "north", "west", "east"])

    ship(assets.sparkSession)
    found = assets.select("GeoAssetID", "Latitude", "Longitude").mapInPandas(run, "GeoAssetID bigint, country string, south double, north double, west double, east double")
    box = geo.polygon(geo.bbox_ring(F.col("south"), F.col("north"), F.col("west"), F.col("east")))
    return assets.join(found, "GeoAssetID").withColumn("point", geo.point(F.col("Longitude"), F.col("Latitude"))).withColumn("bounding_box", box)


def nearest_address(assets: DataFrame, places: DataFrame) -> DataFrame:
    """assets with place, km and country of the nearest known place (id, lon, lat,
    country): reverse geocoding without a provider."""
    at = assets.withColumns({"lon": F.col("Longitude"), "lat": F.col("Latitude")})
    told = nearest(at, places).drop("lon", "lat")
    return told.join(places.select(F.col("id").alias("place"), "country").dropDuplicates(["place"]), "place", "left").select(*assets.columns, "place", "km", "country")
