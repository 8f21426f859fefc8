"""Numbered states of a folder, published one writer at a time.

A state is a small JSON value (which files count, which batches are in). Readers take
the latest; a writer makes the next from it and publishes it under the next number,
which one writer alone can take: the state's file is written whole under a name of its
own and then renamed, without overwriting (atomic where the file system's rename is,
as in HDFS). A writer that comes second starts over from what the first published.
Data files are written before the state that names them, so what a writer left behind
when it failed is never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.errors.exceptions.captured import UnknownException
from pyspark.sql import SparkSession

try:
    from py4j.protocol import Py4JJavaError
except ImportError:  # without a JVM of its own
    Py4JJavaError = UnknownException

FOLDER = "_versions"


class Conflict(Exception):
    """Another writer has published this version."""


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def latest(spark: SparkSession, path: str) -> tuple[int, dict]:
    """The number and value of the latest state; 0 and an empty one if there is none."""
    files, folder = _files(spark, path)
    if not files.exists(folder):
        return 0, {}
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not numbers:
        return 0, {}
    at = spark._jvm.org.apache.hadoop.fs.Path(folder, _name(max(numbers)))
    stream = files.open(at)
    try:
        return max(numbers), json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _name(version: int) -> str:
    return f"{version:012d}.json"


def publish(spark: SparkSession, path: str, version: int, state: dict) -> None:
    """Makes state the given version, or raises Conflict if there is one."""
    jvm = spark._jvm
    files, folder = _files(spark, path)
    files.mkdirs(folder)
    temporary, final = (jvm.org.apache.hadoop.fs.Path(folder, n) for n in (f".{uuid.uuid4().hex}", _name(version)))
    stream = files.create(temporary, True)
    stream.write(bytearray(json.dumps(state).encode()))
    stream.close()
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(files.makeQualified(temporary), files.makeQualified(final), none)
    except Py4JJavaError as e:
        files.delete(temporary, False)
        if files.exists(final):
            raise Conflict(f"version {version} of {path}") from e
        raise


def commit(spark: SparkSession, path: str, change: Callable[[dict], dict | None], tries: int = 50) -> dict:
    """Publishes change(latest state), from the start again whenever another writer
    was first; change returns None if nothing is left to do. Returns the state."""
    for _ in range(tries):
        version, state = latest(spark, path)
        new = change(state)
        if new is None:
            return state
        try:
            publish(spark, path, version + 1, new)
            return new
        except Conflict:
            continue
    raise Conflict(f"{tries} other writers at {path}")
