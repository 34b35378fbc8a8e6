"""Refresh that reads new files and their warm-up days only, from a raw table partitioned by date.

Beside the cache stand, by load, a manifest of the files that were reduced and a frontier: of each entity its last `keep` days
(an array of a fixed length). New files are found by name; the days to read are a list of dates in the scan's partition filter, so
what a refresh reads doesn't depend on the history's length. A load is the features, then its
frontier, then its manifest: a run that stops between is repeated by the next, and the later load wins on reading.

Rows for days before an entity's frontier days (late files) take the entity's days from the cache instead, and the days that they
warm up are reduced again too.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.steps import keep_last
from ..sources.tables import read_if_there


def day_of(path: str) -> str:
    return next(p.removeprefix("date=") for p in unquote(path).split("/") if p.startswith("date="))


def scan(spark: SparkSession, raw: str, schema: StructType, days: list[str]) -> DataFrame:
    """The raw table's partitions of these days."""
    return spark.read.schema(schema).parquet(raw).where(F.col("date").isin([F.lit(d).cast("date") for d in days]))


def newest_frontier(spark: SparkSession, cache: str) -> DataFrame | None:
    found = read_if_there(spark, f"{cache}.frontier")
    return None if found is None else keep_last(found, ["entity"], ["load_seq"]).select("entity", "days")


def refresh_files(spark: SparkSession, raw: str, cache: str, reduce: Callable[[DataFrame], DataFrame], warm_up: int, schema: StructType, provisional: int = 0) -> list[str]:
    """Reduces what the raw table's new files bring; returns the days whose partitions were read for it."""
    files = spark.read.schema(schema).parquet(raw).inputFiles()
    done = read_if_there(spark, f"{cache}.manifest")
    names = spark.createDataFrame([(f,) for f in files], "file string")
    new = [r.file for r in (names if done is None else names.join(done, "file", "left_anti")).collect()]  # a load's files
    if not new:
        return []
    load = 0 if done is None else done.agg(F.max("load_seq")).first()[0] + 1
    brought = spark.read.schema(schema).option("basePath", raw).parquet(*new).select("entity", "date").distinct()
    frontier = newest_frontier(spark, cache)
    held = brought.select("entity", F.lit(None).cast("array<date>").alias("days")).where("false") if frontier is None else frontier
    # The entity's days: those of the frontier and the new ones; from the cache where a new one is older than the frontier's.
    late = brought.join(held, "entity").where(F.col("date") < F.array_min("days")).select("entity").distinct()
    known = held.select("entity", F.explode("days").alias("date"))
    stored = read_if_there(spark, cache)
    if stored is not None and not late.isEmpty():
        known = known.join(late, "entity", "left_anti").unionByName(stored.select("entity", "date").join(late, "entity", "left_semi")).distinct()
    days = known.withColumn("new", F.lit(False)).unionByName(brought.withColumn("new", F.lit(True))).groupBy("entity", "date").agg(F.max("new").alias("new"))
    days = days.join(brought.select("entity").distinct(), "entity", "left_semi")

    w = Window.partitionBy("entity").orderBy("date")

    def within(c: Column | str, before: int, after: int) -> Column:
        return F.coalesce(F.max(F.col(c).cast("int") if isinstance(c, str) else c).over(w.rowsBetween(-before, after)) == 1, F.lit(False))

    # A new day changes itself, the days that it warms up, and the `provisional` ones before it.
    days = days.withColumn("again", within("new", warm_up, provisional))
    days = days.withColumn("read", within("again", 0, warm_up)).cache()
    dates = sorted(str(r.date) for r in days.where("read").select("date").distinct().collect())  # a calendar
    made = reduce(scan(spark, raw, schema, dates).join(days.where("read").select("entity", "date"), ["entity", "date"], "left_semi"))
    made.join(days.where("again").select("entity", "date"), ["entity", "date"], "left_semi").withColumn("load_seq", F.lit(load)).write.mode("append").parquet(cache)
    last = F.slice(F.reverse(F.array_sort(F.collect_set("date"))), 1, 2 * warm_up + provisional + 1)
    days.groupBy("entity").agg(last.alias("days")).withColumn("load_seq", F.lit(load)).write.mode("append").parquet(f"{cache}.frontier")
    spark.createDataFrame([(f,) for f in new], "file string").withColumn("load_seq", F.lit(load)).write.mode("append").parquet(f"{cache}.manifest")
    days.unpersist()
    return dates
