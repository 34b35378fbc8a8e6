"""Incremental materialisation: daily features of a growing intraday table, equal to a full recompute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.steps import keep_last
from ..sources.tables import read_if_there


def refresh(spark: SparkSession, raw: str, cache: str, reduce: Callable[[DataFrame], DataFrame], warm_up: int, schema: StructType, provisional: int = 0, chunk_days: int | None = None) -> None:
    """Appends what the cache lacks. Every entity has a frontier of its own: its last stored day, less `provisional` days.

    An entity's rows after its frontier are reduced with its own `warm_up` days before them; an entity without
    stored days, late or new, is reduced from its first day. Provisional days (labels that still mature) are
    reduced again and replace what was stored when read by `current`. Chunks bound a job's days.
    """
    minutes = spark.read.schema(schema).parquet(raw)
    stored = read_if_there(spark, cache)
    own = minutes.select("entity", "date").distinct()
    newest = Window.partitionBy("entity").orderBy(F.desc("date"))
    if stored is None:
        frontier, load = own.select("entity").distinct().withColumn("frontier", F.lit(None).cast("date")), 0
    else:
        kept = stored.select("entity", "date").distinct().withColumn("_k", F.row_number().over(newest)).where(F.col("_k") == provisional + 1)
        frontier = own.select("entity").distinct().join(kept.select("entity", F.col("date").alias("frontier")), "entity", "left")
        load = (stored.agg(F.max("load_seq")).first()[0] or 0) + 1
    days = own.join(frontier, "entity").withColumn("_place", F.row_number().over(Window.partitionBy("entity").orderBy("date")))
    days = days.withColumn("_new", F.col("frontier").isNull() | (F.col("date") > F.col("frontier"))).cache()
    todo = [r.date for r in days.where("_new").select("date").distinct().orderBy("date").collect()]  # a calendar
    for i in range(0, len(todo), chunk_days or max(1, len(todo))):
        part = todo[i : i + (chunk_days or len(todo))]
        inside = F.col("_new") & F.col("date").between(F.lit(part[0]), F.lit(part[-1]))
        first = days.where(inside).groupBy("entity").agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
        read = days.join(first, "entity").where((F.col("_place") >= F.col("_first") - warm_up) & (F.col("_place") <= F.col("_last"))).select("entity", "date")
        made = reduce(minutes.join(read, ["entity", "date"], "left_semi"))
        made.join(days.where(inside).select("entity", "date"), ["entity", "date"], "left_semi").withColumn("load_seq", F.lit(load)).write.mode("append").parquet(cache)
    days.unpersist()


def current(spark: SparkSession, cache: str) -> DataFrame:
    """The cache's rows, of each entity and day the last that was stored."""
    return keep_last(spark.read.parquet(cache), ["entity", "date"], ["load_seq"]).drop("load_seq")


def correct(spark: SparkSession, raw: str, cache: str, changed: DataFrame, reduce: Callable[[DataFrame], DataFrame], warm_up: int, schema: StructType) -> None:
    """Reduces again the changed days (entity, date) and those that they warm up, whatever the frontier."""
    minutes = spark.read.schema(schema).parquet(raw)
    w = Window.partitionBy("entity").orderBy("date")
    days = minutes.select("entity", "date").distinct().join(changed.select("entity", "date").distinct().withColumn("_c", F.lit(True)), ["entity", "date"], "left").withColumn("_c", F.coalesce("_c", F.lit(False)))
    days = days.withColumn("_again", F.max(F.col("_c").cast("int")).over(w.rowsBetween(-warm_up, 0)) == 1)
    days = days.withColumn("_read", F.max(F.col("_again").cast("int")).over(w.rowsBetween(0, warm_up)) == 1)
    load = (spark.read.parquet(cache).agg(F.max("load_seq")).first()[0] or 0) + 1
    made = reduce(minutes.join(days.where("_read").select("entity", "date"), ["entity", "date"], "left_semi"))
    made.join(days.where("_again").select("entity", "date"), ["entity", "date"], "left_semi").withColumn("load_seq", F.lit(load)).write.mode("append").parquet(cache)


def stream_upsert(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, keys: list[str]) -> None:
    """Drains a folder of files; every batch's rows are numbered by batch, so a later one wins on reading."""

    def put(batch: DataFrame, epoch: int) -> None:
        # A batch that is run again replaces its own folder.
        batch.withColumn("load_seq", F.lit(epoch)).write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    q = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def windowed_counts(events: DataFrame, width: str = "1 hour", slide: str | None = None, late: str = "2 hours") -> DataFrame:
    """Tumbling or sliding windows by type; on a stream, rows later than the watermark are dropped."""
    w = F.window("ts", width, slide) if slide else F.window("ts", width)
    out = events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    out = events.withWatermark("ts", "2 hours").groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("session_window.start").alias("session_start"), "n")
