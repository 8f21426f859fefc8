"""What a session needs: the package on Python workers, and tables in the shared folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_folders: dict[str, str] = {}  # of an application


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to the executors, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    here = Path(__file__).resolve().parent
    target = os.path.join(tempfile.mkdtemp(prefix="emberlane-"), f"{here.name}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, p.relative_to(here.parent))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def shared_dir(spark: SparkSession) -> str:
    """This application's own folder in the one that the cluster shares
    (spark.checkpoint.dir); it goes when the driver ends. Where that is unset, a local
    one will do if the master is local. On a cluster executors do not see each other's
    disks, so there it is an error."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="emberlane-")
        _folders[app] = f"{base.rstrip('/')}/emberlane/{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders[app])
        atexit.register(_removed, path.getFileSystem(spark._jsc.hadoopConfiguration()), path)
    return _folders[app]


def _removed(files, path) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        files.delete(path, True)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Writes df to a table in the shared folder and reads that: lineage ends there,
    and a lost executor costs no recomputation of what came before."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
