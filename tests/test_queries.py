"""Every query with a twin against DuckDB, on the smallest tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")
from quantloom.operators import minute
from quantloom.plans import panels, queries
from quantloom.sources import tables
from quantloom.streaming import incremental

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def plain(v):
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].removesuffix("T00:00:00")
    if isinstance(v, float) and (math.isnan(v) or math.isinf(v)):
        return None
    return round(float(v), 4) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_twin(spark, name):
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{FOLDER}/{f}'")
    got = queries.QUERIES[name](spark, FOLDER)
    rel = con.sql(queries.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(rel.columns)
    a = sorted(([plain(r[c]) for c in cols] for r in got.collect()), key=repr)
    b = sorted(([plain(r[rel.columns.index(c)]) for c in cols] for r in rel.fetchall()), key=repr)
    assert len(a) == len(b)
    assert a == b


def test_incremental_equals_full(spark, tmp_path):
    """New days, an entity that comes late, provisional days, chunks and late corrections."""
    m = panels.minutes(spark, FOLDER).cache()
    days = sorted(r.date for r in m.select("date").distinct().collect())
    late = m.select("entity").distinct().orderBy("entity").first().entity
    raw, cache = str(tmp_path / "raw"), str(tmp_path / "cache")
    reduce = lambda x: minute.apm_segments(x, {"am": (8, 11), "pm": (13, 17)}, 1)
    for k, part in enumerate((days[:12], days[12:13], days[13:])):
        rows = m.where(m["date"].isin(part))
        # the late entity's history arrives with the second load
        rows = rows.where(m["entity"] != late) if k == 0 else rows.unionByName(m.where((m["entity"] == late) & m["date"].isin(days[:12]))) if k == 1 else rows
        rows.write.mode("append").parquet(raw)
        incremental.refresh(spark, raw, cache, reduce, 1, m.schema, provisional=1, chunk_days=5)
    rows = lambda: sorted(map(repr, incremental.current(spark, cache).collect()))
    full = sorted(map(repr, reduce(m).collect()))
    assert rows() == full
    changed = m.where(m["date"] == days[3]).withColumn("close", m["close"] * 2)
    fixed = m.where(m["date"] != days[3]).unionByName(changed)
    other = str(tmp_path / "fixed")
    fixed.write.parquet(other)
    incremental.correct(spark, other, cache, changed, reduce, 1, m.schema)
    assert rows() == sorted(map(repr, reduce(fixed).collect()))


def test_stream_keeps_the_last_load(spark, tmp_path):
    src = str(tmp_path / "src")
    for v in (1.0, 2.0):
        spark.createDataFrame([("A", v), ("B", v)], "k string, v double").coalesce(1).write.mode("append").parquet(src)
        incremental.stream_upsert(spark, src, spark.read.parquet(src).schema, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"])
    rows = tables.upsert(None, spark.read.parquet(str(tmp_path / "out")), ["k"])
    from quantloom.operators.steps import keep_last

    assert {r.k: r.v for r in keep_last(rows, ["k"], ["load_seq"]).collect()} == {"A": 2.0, "B": 2.0}
