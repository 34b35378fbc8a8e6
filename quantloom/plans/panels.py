"""The driver's tables in the engine's roles, as DataFrames and as SQL text for the twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read

#: Monthly bars of suppliers. The price is a square root: exact in every engine, and never a rounding tie.
PANEL_SQL = """px AS (SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sqrt(l_extendedprice / l_quantity) AS p, l_quantity AS q, sqrt(l_extendedprice) AS t, row(l_shipdate, l_orderkey, l_partkey, l_linenumber, l_extendedprice) AS k FROM lineitem WHERE l_quantity > 0),
panel AS (SELECT entity, date, arg_min(p, k) AS open, max(p) AS high, min(p) AS low, arg_max(p, k) AS close, sum(q) AS volume, sum(t) AS turnover FROM px GROUP BY 1, 2)"""

MINUTES_SQL = """ev AS (SELECT event_type AS entity, CAST(ts AS DATE) AS date, CAST(extract(hour FROM ts) AS INTEGER) AS minute, sqrt(abs(value) + 1) AS p, row(ts, event_id) AS k FROM events),
minutes AS (SELECT entity, date, minute, arg_min(p, k) AS open, max(p) AS high, min(p) AS low, arg_max(p, k) AS close, sum(p) AS volume, sum(p * p) AS turnover FROM ev GROUP BY 1, 2, 3)"""


def panel(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem").where("l_quantity > 0")
    p = F.sqrt(F.col("l_extendedprice") / F.col("l_quantity"))
    k = F.struct("l_shipdate", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    px = li.select(F.col("l_suppkey").alias("entity"), F.to_date(F.date_trunc("month", "l_shipdate")).alias("date"), p.alias("p"), F.col("l_quantity").alias("q"), F.sqrt("l_extendedprice").alias("t"), k.alias("k"))
    return px.groupBy("entity", "date").agg(F.min_by("p", "k").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "k").alias("close"), F.sum("q").alias("volume"), F.sum("t").alias("turnover"))


def minutes(spark: SparkSession, d: str) -> DataFrame:
    ev = read(spark, d, "events")
    p = F.sqrt(F.abs("value") + 1)
    rows = ev.select(F.col("event_type").alias("entity"), F.to_date("ts").alias("date"), F.hour("ts").alias("minute"), p.alias("p"), F.struct("ts", "event_id").alias("k"))
    return rows.groupBy("entity", "date", "minute").agg(F.min_by("p", "k").alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), F.max_by("p", "k").alias("close"), F.sum("p").alias("volume"), F.sum(F.col("p") * F.col("p")).alias("turnover"))
