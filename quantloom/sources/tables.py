"""Sources and sinks: long tables, batched fetches, upserts, panels on disk."""

from __future__ import annotations

import hashlib
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import clean
from ..operators.steps import as_of, keep_last
from ..shipping import stored


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def normalise(df: DataFrame, entity: str, date: str, columns: list[str]) -> DataFrame:
    """Long form: entity, date, doubles; NaN and infinities become NULL."""
    return df.select(F.col(entity).alias("entity"), F.to_date(date).alias("date"), *(clean(c).alias(c) for c in columns))


def melt(wide: DataFrame, key: str = "date", value: str = "value") -> DataFrame:
    """A wide panel (a column an entity) as a long table without missing cells."""
    names = [c for c in wide.columns if c != key]
    return wide.unpivot(key, names, "entity", value).where(F.col(value).isNotNull())


def pivot(long: DataFrame, value: str, entities: list[str]) -> DataFrame:
    """Export form. Entities must be named, so no pass looks for them."""
    return long.groupBy("date").pivot("entity", entities).agg(F.first(value))


def columns_of(long: DataFrame, width: int = 64) -> DataFrame:
    """entity, block, place: the columns of a wide panel of any number of entities, in their order, cut into blocks of up to `width`.

    A task of the sort numbers its own entities, so none holds all; stored, as both ways must number alike.
    """
    named = long.select("entity").distinct().orderBy("entity").withColumn("_id", F.monotonically_increasing_id())
    return stored(named.select("entity", F.floor(F.col("_id") / width).alias("block"), F.pmod("_id", F.lit(width)).cast("int").alias("place")), "columns")


def pivot_blocks(long: DataFrame, value: str, columns: DataFrame, width: int = 64) -> DataFrame:
    """Export form in blocks: a row a date and block, a column a place of the block (`columns_of`), with the number of rows beside its value.

    A plan has `width` columns whatever the number of entities, and a row is bounded. The number tells a NULL that was there from a missing cell.
    """
    placed = long.join(columns, long["entity"].eqNullSafe(columns["entity"])).select("date", "block", "place", F.col(value).alias("value"))
    # Exchanged as cells: partial aggregates would be rows of mostly empty columns.
    return placed.repartition("date", "block").groupBy("date", "block").pivot("place", list(range(width))).agg(F.first("value").alias("value"), F.count(F.lit(1)).alias("rows"))


def melt_blocks(wide: DataFrame, columns: DataFrame, value: str = "value") -> DataFrame:
    """A wide panel in blocks as a long table of the cells that were there; entities are names of columns, so text."""
    places = [c.removesuffix("_value") for c in wide.columns if c.endswith("_value")]
    cells = wide.select("date", "block", F.inline(F.array(*(F.struct(F.lit(int(k)).alias("place"), F.col(f"{k}_value").alias(value), F.col(f"{k}_rows").alias("_rows")) for k in places))))
    return cells.where("_rows > 0").join(columns, ["block", "place"]).select(F.col("entity").cast("string").alias("entity"), "date", value)


def adjusted(daily: DataFrame, factors: DataFrame, prices: list[str], volume: str | None = None) -> DataFrame:
    """Prices times the cumulative factor in force (1 before the first); volume divided by it."""
    on = as_of(daily, factors, "cum_factor", default=1.0)
    out = on.withColumns({c: F.col(c) * F.col("cum_factor") for c in prices})
    return out.withColumn(volume, F.col(volume) / F.col("cum_factor")) if volume else out


def intervals_to_daily(days: DataFrame, events: DataFrame, value: str) -> DataFrame:
    """Point-in-time value of interval starts on every day of a grid; events on other days count too."""
    return as_of(days, events, value).where(F.col(value).isNotNull())


def identity(params: dict, version: int) -> str:
    return hashlib.sha1(json.dumps({"params": params, "version": version}, sort_keys=True).encode()).hexdigest()[:10]


def cache_path(root: str, key: str, params: dict, version: int = 1) -> str:
    """A derived table's folder: another parameter or version is another table."""
    return f"{root.rstrip('/')}/{key}-{identity(params, version)}"


def upsert(old: DataFrame | None, new: DataFrame, keys: list[str], order: str = "load_seq") -> DataFrame:
    """Union that keeps the row of the highest load of each key."""
    return new if old is None else keep_last(old.unionByName(new, allowMissingColumns=True), keys, [order])


def write_partitioned(df: DataFrame, path: str, by: str = "date") -> None:
    """One exchange by the partition column; only partitions with rows are replaced."""
    df.repartition(by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def small_files(spark: SparkSession, path: str, by: str, target_bytes: int) -> DataFrame:
    """Partitions that have more files than their bytes need: by, files, wanted. Sizes come with the scan, no column is read."""
    files = spark.read.parquet(path).select(by, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()
    sized = files.groupBy(by).agg(F.count(F.lit(1)).alias("files"), F.greatest(F.ceil(F.sum("bytes") / target_bytes), F.lit(1)).alias("wanted"))
    return sized.where("files > wanted")


def compact(spark: SparkSession, path: str, by: str = "date", target_bytes: int = 128 << 20, order: tuple[str, ...] = ("entity",)) -> int:
    """Rewrites partitions of many small files as files of about the target size; others aren't touched. Tells how many were.

    Rows are stored before their partition is replaced, so a job that ends early leaves the old or the new files of each.
    """
    todo = stored(small_files(spark, path, by, target_bytes), "small")
    rows = spark.read.parquet(path).join(F.broadcast(todo), by)  # a row a partition
    held = stored(rows.withColumn("_part", F.pmod(F.xxhash64(*order), F.col("wanted"))), "compacted")
    n = todo.count()
    if n:
        out = held.repartition(by, "_part").sortWithinPartitions(by, "_part", *order).drop("_part", "files", "wanted")
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return n


def write_bucketed(minutes: DataFrame, table: str, buckets: int = 256) -> DataFrame:
    """Minutes bucketed by entity and sorted: windows and groups that hold the entity need no exchange of them."""
    minutes.repartition(buckets, "entity").write.mode("overwrite").bucketBy(buckets, "entity").sortBy("entity", "date", "minute").saveAsTable(table)
    return minutes.sparkSession.table(table)


def write_markdown(df: DataFrame, path: str, digits: int = 4) -> None:
    """A report of few rows as a markdown table, a line a row, in the report's order of columns."""
    shown = [F.coalesce(F.format_number(c, digits) if t in ("double", "float") else F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("\\|")), F.lit("")) for c, t in df.dtypes]
    line = lambda cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    head = df.sparkSession.range(1).select(line([F.lit(c) for c in df.columns]).alias("value")).unionByName(df.sparkSession.range(1).select(line([F.lit("-")] * len(df.columns)).alias("value")))
    head.unionByName(df.select(line(shown).alias("value"))).coalesce(1).write.mode("overwrite").text(path)


def write_signal(ranked: DataFrame, path: str, merged: bool = False) -> None:
    """Text, a line `date_code` each, by date and position: a folder of one file a day, or one range-ordered set of files."""
    day = F.date_format("date", "yyyy-MM-dd")
    rows = ranked.select("date", "position", day.alias("day"), F.concat_ws("_", day, F.col("entity").cast("string")).alias("value"))
    if merged:
        rows.repartitionByRange("date", "position").sortWithinPartitions("date", "position").select("value").write.mode("overwrite").text(path)
    else:
        rows.repartition("day").sortWithinPartitions("day", "position").select("day", "value").write.mode("overwrite").partitionBy("day").text(path)


def write_panel(panel: DataFrame, root: str, stage: str, source: str, group: str, factor: str, value: str = "value", skip_existing: bool = False) -> bool:
    """One factor's panel (or its cleaned or neutral stage) as entity, date, value; tells whether it was written."""
    path = f"{root.rstrip('/')}/stage={stage}/source={source}/grp={group}/factor={factor}"
    if skip_existing and read_if_there(panel.sparkSession, path) is not None:
        return False
    panel.select("entity", "date", F.col(value).cast("double").alias("value")).where("value is not null").write.mode("overwrite").parquet(path)
    return True


def read_panels(spark: SparkSession, root: str, like: str = "%", stage: str = "raw") -> DataFrame:
    """Long table of all factors whose name matches: partition columns are the catalogue."""
    return spark.read.parquet(root).where((F.col("stage") == stage) & F.col("factor").like(like)).select("entity", "date", "factor", "value")


def discover(spark: SparkSession, root: str, like: str = "%") -> DataFrame:
    """stage, source, grp, factor of what is stored, from the folders' names."""
    return spark.read.parquet(root).where(F.col("factor").like(like)).select("stage", "source", "grp", "factor").distinct()


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def labels_or(spark: SparkSession, path: str, make) -> DataFrame:
    """A stored label table, or the one that `make()` computes."""
    found = read_if_there(spark, path)
    return make() if found is None else found


def write_days(df: DataFrame, path: str, skip_existing: bool = True) -> None:
    """A folder a day; days that are stored already aren't written again. Spark's committer makes each write whole or none."""
    stored = read_if_there(df.sparkSession, path) if skip_existing else None
    new = df if stored is None else df.join(F.broadcast(stored.select(F.col("date").cast("date").alias("date")).distinct()), "date", "left_anti")
    new.repartition("date").write.mode("append").partitionBy("date").parquet(path)


def write_report(df: DataFrame, path: str, kind: str = "csv", stamp: str | None = None) -> None:
    """csv (four decimals) or json; with a stamp, a new folder for each run, of which `latest` reads the newest."""
    rounded = df.select(*(F.format_number(c, 4).alias(c) if kind == "csv" and t in ("double", "float") else F.col(c) for c, t in df.dtypes))
    out = rounded.write.mode("overwrite")
    target = f"{path.rstrip('/')}/stamp={stamp}" if stamp else path
    out.option("header", True).csv(target) if kind == "csv" else out.json(target)


def latest(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    every = spark.read.option("header", True).csv(path) if kind == "csv" else spark.read.json(path)
    return every.join(F.broadcast(every.agg(F.max("stamp").alias("stamp"))), "stamp", "left_semi").drop("stamp")


def universe(members: DataFrame, index: str | None = None) -> DataFrame:
    """Entities of one index, or all."""
    return (members if index is None or index == "ALL" else members.where(F.col("index_id") == index)).select("entity").distinct()


def calendar(rows: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Trading days: the distinct dates of a table, numbered from 0."""
    days = rows.select("date").distinct()
    for bound, op in ((start, "__ge__"), (end, "__le__")):
        days = days if bound is None else days.where(getattr(F.col("date"), op)(F.lit(bound).cast("date")))
    return days.withColumn("place", F.row_number().over(Window.orderBy("date")) - 1)


def lookup(rows: DataFrame, wide: DataFrame, key: str, output: str, by: str = "date", aliases: dict[str, str] | None = None) -> DataFrame:
    """The value of the column of `wide` that a row's key names, on the row's date; aliases are further names of columns."""
    names = [c for c in wide.columns if c != by]
    long = wide.unpivot(by, names, "_k", output)
    for other, name in (aliases or {}).items():
        long = long.unionByName(wide.select(by, F.lit(other).alias("_k"), F.col(name).alias(output)))
    return rows.join(long.withColumnRenamed("_k", key), [by, key], "left")


def by_date(rows: DataFrame, series: DataFrame) -> DataFrame:
    """A date's series values on every row of it; one row a date is broadcast."""
    return rows.join(F.broadcast(series), "date", "left")


def last_value(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """One row a cell, its last value in order."""
    return rows.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def index_of(a: DataFrame, b: DataFrame, how: str, keys: tuple[str, ...] = ("entity", "date")) -> DataFrame:
    """Union, intersection or difference of two tables' keys."""
    x, y = a.select(*keys), b.select(*keys)
    return {"union": lambda: x.union(y).distinct(), "intersection": lambda: x.intersect(y), "difference": lambda: x.subtract(y)}[how]()


def sampled(df: DataFrame, keys: list[str], share: float, seed: int = 0) -> DataFrame:
    """The same rows at every call and partitioning: those whose keys hash below the share."""
    return df.where(F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1_000_000)) < int(share * 1_000_000))


def batches(fetch, ids: list[str], spark: SparkSession, schema: str, size: int = 500) -> DataFrame:
    """A remote source read by batches of ids, one task each: fetch(ids) gives pandas rows.

    A failing batch fails its task, which Spark runs again, and after that the whole job: no part of it is returned.
    """
    groups = [ids[i : i + size] for i in range(0, len(ids), size)]
    todo = spark.createDataFrame([(g,) for g in groups], "ids array<string>").repartition(max(1, len(groups)))

    def read(parts):
        for part in parts:
            for some in part["ids"]:
                yield fetch(list(some))

    return todo.mapInPandas(read, schema)


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row a column: count, sum, sum of squares, extremes, mean, deviation."""
    long = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns))))
    x = F.col("x")
    return long.groupBy("column").agg(F.count(x).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares"), F.min(x).alias("lowest"), F.max(x).alias("highest"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"))


def verify(a: DataFrame, b: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Largest absolute difference of each column over common keys."""
    on = a.alias("a").join(b.alias("b"), keys)
    return on.agg(*(F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in columns))
