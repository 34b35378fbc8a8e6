"""The wide panel in blocks of columns; factors that stand beside each other."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quantloom.operators import evaluation as ev
from quantloom.plans import queries
from quantloom.sources import tables

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"


def test_blocks_hold_every_cell_of_entities_of_any_number(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int"))
    long = spark.range(3500).select(F.when(F.col("id") >= 7, F.floor(F.col("id") / 7)).alias("entity"), day.alias("date"), F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("x"))
    columns = tables.columns_of(long, 8)
    assert columns.count() == 500 == columns.select("block", "place").distinct().count()
    wide = tables.pivot_blocks(long, "x", columns, 8)
    assert len(wide.columns) == 2 + 2 * 8
    assert wide.count() == 7 * columns.select("block").distinct().count()
    got = sorted(map(repr, tables.melt_blocks(wide, columns).collect()))
    assert got == sorted(map(repr, long.select(F.col("entity").cast("string"), "date", F.col("x").alias("value")).collect()))


def test_wide_and_back_has_all_entities_of_the_panel(spark, tmp_path):
    """Entities that no supplier has, none at all, and a cell without a price: as in the twin."""
    duckdb = pytest.importorskip("duckdb")
    rows = [(k, k, s, 1, 2.0, p, dt.datetime(2024, 1 + k, 5)) for k, (s, p) in enumerate([(1, 8.0), (1, 18.0), (2, 32.0), (77, 50.0), (None, 72.0), (2, None), (1, 98.0)])]
    spark.createDataFrame(rows, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1,), (2,), (3,)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    plain = lambda rows: sorted(((r[0], str(r[1]), r[2] and round(r[2], 9)) for r in rows), key=repr)
    got = queries.QUERIES["wide_and_back"](spark, str(tmp_path)).select("entity", "date", "value").collect()
    want = con.sql(f"select entity, date, value from ({queries.SQL['wide_and_back']})").fetchall()
    assert plain(got) == plain(want) and len(got) == 7


def test_wide_inventory_and_correlation_are_those_of_long_rows(spark):
    """Ties, flat dates, missing values, NaN, infinities, signed zeros, keys that are NULL; parts that aren't full."""
    r = np.random.default_rng(3)
    names = [f"f{k}" for k in range(5)]
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0]
    rows = []
    for e in range(40):
        for day in range(12):
            x = [float(r.integers(0, 6)), float(r.normal()), odd[r.integers(0, 6)], 1.0, None if day < 6 else float(r.integers(0, 3))]
            rows.append((None if e == 39 else e, None if day == 11 and e % 2 else dt.date(2024, 1, 1 + day), *x, 10 + float(r.integers(0, 4)) if r.random() > 0.1 else None))
    wide = spark.createDataFrame(rows, "entity long, date date, " + ", ".join(f"{n} double" for n in names) + ", close double").dropDuplicates(["entity", "date"]).withColumns({"r1": ev.ahead(1), "r2": ev.ahead(2)}).cache()
    long = wide.unpivot(["entity", "date"], names, "factor", "value").where("value is not null")
    plain = lambda df: sorted((tuple(round(v, 12) if isinstance(v, float) else v for v in x) for x in df.collect()), key=repr)
    columns = ["factor", "horizon", "date", "n", "ic"]
    want = ev.ic_series(long.join(ev.forward_returns(wide, [1, 2]), ["entity", "date"]), "value", "ret", ["factor", "horizon", "date"], True, 3)
    for at_once in (2, 16):
        assert plain(ev.wide_ic_series(wide, names, {1: "r1", 2: "r2"}, 3, at_once).select(columns)) == plain(want.select(columns))
    assert want.where("ic is null").count() and want.where("ic is not null").count() > 50
    got = ev.wide_inventory(wide, names, {1: "r1", 2: "r2"})
    assert plain(got) == plain(ev.inventory(long, wide, (1, 2)).select(got.columns))
    assert plain(ev.wide_correlation(wide, names, True)) == plain(ev.factor_correlation(long, True, names))


def shuffled(spark, after=-1):
    """Bytes that later stages have written for exchanges, and the last stage."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    each = [(s.stageId(), s.shuffleWriteBytes()) for s in (stages.apply(i) for i in range(stages.size()))]
    return sum(b for k, b in each if k > after), max((k for k, _ in each), default=-1)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no tables")
def test_clustered_factors_exchanges_a_value_once(spark):
    folder = "/root/testdata/sf0.01"
    cells = queries.panel(spark, folder).count()
    _, last = shuffled(spark)
    assert queries.QUERIES["clustered_factors"](spark, folder).count() == 9
    assert shuffled(spark, last)[0] < 1000 * cells
