"""What the operators share: table access, shared scratch tables, Arrow helpers."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import gc
import os
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

PACKAGE = Path(__file__).resolve().parents[1]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_shipped: set[tuple[str, str]] = set()


def ship(spark: SparkSession, *files: str) -> None:
    """Sends this package, and files that tasks read, to the executors; once an application."""
    sc = spark.sparkContext
    if (sc.applicationId, "") not in _shipped:
        _shipped.add((sc.applicationId, ""))
        archive = os.path.join(tempfile.mkdtemp(prefix="quantloom-"), f"{PACKAGE.name}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(PACKAGE.rglob("*.py")):
                z.write(f, f.relative_to(PACKAGE.parent))
        sc.addPyFile(archive)
    for f in files:
        if (sc.applicationId, f) not in _shipped:
            _shipped.add((sc.applicationId, f))
            sc.addFile(f)


def local_file(path: str) -> str:
    """A shipped file's path in a task; on the driver, and where it stands at the same place, that itself."""
    return path if os.path.exists(path) else SparkFiles.get(os.path.basename(path))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); a local one only in local mode."""
    sc = spark.sparkContext
    if folder := spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir():
        return folder.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(folder := "file://" + tempfile.mkdtemp(prefix="quantloom-"))
    return folder


_homes: dict[str, tuple[SparkSession, str, str]] = {}


def home(spark: SparkSession) -> tuple[str, str]:
    """This application's scratch database and its folder, which lies in the shared one and is dropped with it."""
    key = spark.sparkContext.applicationId
    if key not in _homes:
        name = f"quantloom_{uuid.uuid4().hex}"
        folder = f"{shared_dir(spark)}/{name}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
        _homes[key] = spark, name, folder
    return _homes[key][1:]


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder's path; it goes with the database."""
    return f"{home(spark)[1]}/{tag}_{uuid.uuid4().hex}"


@atexit.register
def _clean() -> None:
    for spark, name, _ in _homes.values():
        try:
            spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        except Exception:  # the session may have ended before the interpreter
            break


_owner: contextvars.ContextVar[str | None] = contextvars.ContextVar("owner", default=None)
_owned: dict[str, list[str]] = {}


@contextlib.contextmanager
def owned(owner: str, spark: SparkSession | None = None, docs: DataFrame | None = None) -> Iterator[str]:
    """Scratch tables made within belong to this owner, or to that of an outer call.

    With docs, those that the owner made before and docs doesn't read are dropped first. No other caller's are.
    """
    owner = _owner.get() or owner
    if docs is not None:
        read = docs.inputFiles()
        for name in [x for x in _owned.get(owner, ()) if not any(f"/{x.split('.')[1]}/" in f for f in read)]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            _owned[owner].remove(name)
    token = _owner.set(owner)
    try:
        yield owner
    finally:
        _owner.reset(token)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Lineage cut: a Parquet table in the shared folder, read back; survives lost executors.

    The job's shuffle files go when it is done: nothing else reads them.
    """
    spark = df.sparkSession
    name = f"{home(spark)[0]}.{tag}_{uuid.uuid4().hex}"
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").saveAsTable(name)
    finally:
        spark.conf.set(CLEAN_UP, before)
    if owner := _owner.get():
        _owned.setdefault(owner, []).append(name)
    return spark.table(name)


def ascii_lower(c: Column | str) -> Column:
    return F.translate(c, UPPER, LOWER)


def in_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    ship(df.sparkSession)
    if isinstance(schema, StructType) and any("." in c for c in df.columns):
        # Python tasks can't be given a column with a dot in its name: rows pass under numbers.
        plain = StructType([StructField(f"_{i}", f.dataType) for i, f in enumerate(schema)])
        return df.toDF(*plain.names).mapInArrow(fn, plain).toDF(*schema.names)
    return df.mapInArrow(fn, schema)


def record_batch(names: list[str], types: list[pa.DataType], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def slices(batches: Iterator[pa.RecordBatch], text: int = 1, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a slice's texts stay near max_bytes; a longer row is a slice alone."""
    for b in batches:
        sizes = pa.compute.binary_length(b.column(text)).fill_null(0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > max_bytes:
                yield b.slice(start, i - start)
                start, total = i, 0
            total += n
        if len(sizes) > start:
            yield b.slice(start)


def worker_store(family: str, name: str) -> dict:
    """A dict that a reused Python worker keeps while tasks of one family of operators run in it."""
    stores = vars(sys.modules[__name__]).setdefault("_stores", {})
    if stores.get("family") != family:
        stores.clear()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library keeps its own counsel
            pass
        stores["family"] = family
    return stores.setdefault(name, {})
