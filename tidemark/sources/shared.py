"""What driver and executors share: tables in a common folder, and this package."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_paths: dict[str, SparkSession] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once an application; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        folder = tempfile.mkdtemp(prefix="tidemark-package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        package = Path(__file__).resolve().parents[1]
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a temporary folder for a local master, as in tests, and an error for a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.conf.get("spark.master", "local").split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir names the folder that driver and executors share; it is not set")
        found = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df`` written to the shared folder and read back.

    This cuts the lineage in a way that outlives a lost executor: later stages
    reread the files instead of recomputing.  The files go with ``discard`` or the application.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _paths:
        atexit.register(_remove_all)
    _paths[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes the files of ``stored`` tables that no later step reads; others are left alone."""
    for table in tables:
        path = getattr(table, "_stored_at", None)
        if path in _paths:
            _remove(_paths.pop(path), path)


def sweep(spark: SparkSession) -> None:
    """Lets go of the files of shuffles that no plan needs any more.

    Spark removes them when the driver collects garbage, which a driver with little to do puts off while the disks fill.
    """
    spark.sparkContext._jvm.System.gc()


def _remove_all() -> None:
    while _paths:
        path, spark = _paths.popitem()
        _remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder wherever Spark can write."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session is gone already; the application's folder goes with it
        pass
