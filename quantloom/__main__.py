"""Command line: python -m quantloom COMMAND --data FOLDER ...

factor      a specification (JSON) over `daily` (and `minutes`, ...) tables of the folder, written as a panel
evaluate    a stored panel against prices, masks and styles, written as a report
library     the price and volume factors, a panel each; those that are stored already are skipped
refresh     an intraday reducer's new days, appended
signal      the best entities of each day of a stored panel, as text
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import evaluation as ev
from .operators import minute
from .operators.panel import all_factors, factor_names
from .plans import spec
from .sources import tables
from .streaming import incremental


def options(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="quantloom", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("command", choices=["factor", "evaluate", "library", "refresh", "signal"])
    p.add_argument("--data", required=True, help="folder of Parquet tables")
    p.add_argument("--out", required=True, help="folder that is written")
    p.add_argument("--spec", help="factor: the specification's file")
    p.add_argument("--panel", help="evaluate, signal: the stored panel's folder")
    p.add_argument("--only", nargs="*", help="library: factors to build")
    p.add_argument("--action", default="minute_apm_segments", help="refresh: the reducer")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--top", type=int, default=50)
    p.add_argument("--min-samples", type=int, default=30)
    p.add_argument("--dry-run", action="store_true", help="library: only name what would be built")
    return p.parse_args(args)


def run(spark: SparkSession, o: argparse.Namespace) -> list[str]:
    """Writes what the command makes and returns the names of it."""
    read = lambda name: tables.read(spark, o.data, name)
    if o.command == "factor":
        with open(o.spec) as f:
            recipe = json.load(f)
        names = [n for n in ("daily", "minutes", "financials", "factors", "calendar", "index_series", "returns") if tables.read_if_there(spark, f"{o.data.rstrip('/')}/{n}.parquet") is not None]
        made = spec.run(recipe, spec.Context({n: read(n) for n in names}, start=o.start, end=o.end))
        tables.write_panel(made, o.out, "raw", "spec", "own", recipe["factor"]["name"], recipe["factor"]["column"])
        return [recipe["factor"]["name"]]
    if o.command == "library":
        daily = read("daily")
        done = {r.factor for r in tables.discover(spark, o.out).select("factor").collect()} if tables.read_if_there(spark, o.out) is not None else set()
        todo = [n for n in (o.only or factor_names()) if n not in done]
        if todo and not o.dry_run:
            # One pass makes all factors; each becomes a partition.
            wide = all_factors(daily, only=todo, as_float=True).select("entity", F.date_format("date", "yyyy-MM-dd").cast("date").alias("date"), *todo)
            long = wide.unpivot(["entity", "date"], todo, "factor", "value").where("value is not null")
            long.withColumns({"stage": F.lit("raw"), "source": F.lit("daily"), "grp": F.lit("library")}).repartition("factor").write.mode("append").partitionBy("stage", "source", "grp", "factor").parquet(o.out)
        return todo
    if o.command == "evaluate":
        panel = spark.read.parquet(o.panel).withColumnRenamed("value", "x")
        report = ev.evaluate_factor(within(panel, o), ev.masks(read("flags")), read("daily"), read("styles"), min_samples=o.min_samples)
        tables.write_report(report, o.out, "json")
        return ["report"]
    if o.command == "signal":
        tables.write_signal(ev.top_n(within(spark.read.parquet(o.panel), o), "value", o.top), o.out)
        return ["signal"]
    schema = read("minutes").schema
    incremental.refresh(spark, f"{o.data.rstrip('/')}/minutes.parquet", o.out, lambda m: minute.reduce_minutes(m, o.action), minute.warm_up(o.action, {}), schema)
    return [o.action]


def within(df: DataFrame, o: argparse.Namespace) -> DataFrame:
    return spec.Context({}, start=o.start, end=o.end).between(df)


if __name__ == "__main__":
    asked = options()
    session = SparkSession.builder.appName("quantloom").config("spark.sql.session.timeZone", os.environ.get("TZ", "UTC")).getOrCreate()
    print("\n".join(run(session, asked)))
