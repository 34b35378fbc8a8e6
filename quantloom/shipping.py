"""This package on the executors, and tables in the folder that they share."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once an application; the archive is read from the driver by Spark's own file server."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    archive = os.path.join(tempfile.mkdtemp(prefix="quantloom-"), f"{PACKAGE.name}_core.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    sc.addPyFile(archive)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only in local mode."""
    sc = spark.sparkContext
    if folder := spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir():
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(folder := "file://" + tempfile.mkdtemp(prefix="quantloom-"))
    return folder


_homes: dict[str, tuple[SparkSession, str]] = {}


def stored(df: DataFrame, tag: str) -> DataFrame:
    """The rows as a table in the shared folder: a short plan, read as often as needed, that outlives executors. Dropped at the end."""
    spark = df.sparkSession
    key = spark.sparkContext.applicationId
    if key not in _homes:
        name = f"quantloom_core_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark)}/{name}'")
        _homes[key] = spark, name
    table = f"{_homes[key][1]}.{tag}_{uuid.uuid4().hex}"
    df.write.saveAsTable(table)
    return spark.table(table)


@atexit.register
def _clean() -> None:
    for spark, name in _homes.values():
        try:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        except Exception:  # the session may have ended before the interpreter
            break
