"""Small files merged, minutes bucketed by entity, reports as markdown."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from quantloom.operators import minute
from quantloom.sources import tables


def test_compaction_rewrites_partitions_of_small_files_only(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(400).select((F.col("id") % 7).alias("entity"), F.expr("date'2024-01-01' + cast(id % 4 as int)").alias("date"), F.col("id").cast("double").alias("x"))
    rows.where("date < '2024-01-04'").repartition(5).write.partitionBy("date").parquet(path)
    rows.where("date = '2024-01-04'").coalesce(1).write.mode("append").partitionBy("date").parquet(path)
    files = lambda: {str(p) for p in (tmp_path / "days").rglob("*.parquet")}
    before = files()
    assert len(before) == 16 and tables.compact(spark, path) == 3
    after = files()
    assert len(after) == 4 and len(before & after) == 1
    got = spark.read.parquet(path).select("entity", "date", "x")
    assert got.exceptAll(rows).count() == 0 and got.count() == 400
    assert tables.compact(spark, path) == 0 and files() == after
    # a smaller target keeps more files
    rows.where("date = '2024-01-01'").repartition(6).write.mode("append").partitionBy("date").parquet(path)
    assert tables.small_files(spark, path, "date", 1).count() == 0 and tables.small_files(spark, path, "date", 1 << 20).count() == 1


def test_bucketed_minutes_need_no_exchange(spark):
    m = spark.range(2 * 30 * 5).select((F.col("id") % 2).alias("entity"), F.expr("date'2024-01-01' + cast(floor(id / 10) as int)").alias("date"), F.expr("cast(floor(id / 2) % 5 as int)").alias("minute"), *(F.expr(f"1.0D + (id * {k}) % 11").alias(c) for k, c in ((3, "open"), (5, "high"), (2, "low"), (7, "close"), (13, "volume"), (17, "turnover"))))
    old = {k: spark.conf.get(k) for k in ("spark.sql.requireAllClusterKeysForCoPartition", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bucketed = tables.write_bucketed(m, "bucketed_minutes", 4)
        out = minute.peak_ridge_valley(bucketed, std_window=5, slots=list(range(5)))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.findall(r"Exchange hashpartitioning[^\n]*", plan), plan
        assert out.exceptAll(minute.peak_ridge_valley(m, std_window=5, slots=list(range(5)))).count() == 0 and out.count() == 60
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.sql("DROP TABLE IF EXISTS bucketed_minutes")


def test_markdown_report(spark, tmp_path):
    df = spark.createDataFrame([("a|b", 1.23456, 3), ("c", None, 4)], "name string, x double, n int")
    tables.write_markdown(df, str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == ["| name | x | n |", "| - | - | - |", "| a\\|b | 1.2346 | 3 |", "| c |  | 4 |"]
