"""Stateful and pruned refreshes against a full recompute, over restarts, late entities and late rows."""

import os

import pytest
from pyspark.sql import functions as F

from quantloom.operators import minute
from quantloom.plans import panels
from quantloom.streaming import incremental, pruned, stateful

FOLDER = "/root/testdata/sf0.001"
SLOTS = list(range(24))
REDUCERS = {
    "kinds": (lambda m: minute.peak_ridge_valley(m, 5, slots=SLOTS), 10),
    "smart": (lambda m: minute.smart_money(m), 10),
    "segments": (lambda m: minute.apm_segments(m, {"am": (8, 11), "pm": (13, 17)}, 1), 1),
    "tide": (lambda m: minute.tide(m, 2, 1, 1, 10, slots=SLOTS), 0),
}


@pytest.fixture(scope="module")
def raw(spark):
    m = panels.minutes(spark, FOLDER).cache()
    return m, sorted(r.date for r in m.select("date").distinct().collect()), m.select("entity").distinct().orderBy("entity").first().entity


def shown(df):
    return sorted(str([round(x, 9) if isinstance(x, float) else x for x in r]) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("name", list(REDUCERS))
def test_stateful_refresh_equals_full(spark, tmp_path, raw, name):
    """Three calls from one checkpoint; the second brings a late entity's history, the third the missing half of a day."""
    (m, days, late), (reduce, warm_up) = raw, REDUCERS[name]
    folder = lambda n: str(tmp_path / n)
    half = (m["date"] == days[19]) & (m["minute"] > 12)
    parts = [m.where(m["date"].isin(days[:15]) & (m["entity"] != late)), m.where((m["date"].isin(days[15:20]) | (m["entity"] == late) & m["date"].isin(days[:20])) & ~half), m.where(half | m["date"].isin(days[20:]))]
    for part in parts:
        part.coalesce(2).write.mode("append").parquet(folder("raw"))
        stateful.refresh_stream(spark, folder("raw"), folder("cache"), folder("late"), folder("cp"), reduce, warm_up, m.schema, provisional=2)
    assert shown(stateful.stored(spark, folder("cache"))) == shown(reduce(m))
    assert spark.read.parquet(folder("late")).count() == 0


def test_rows_too_old_for_the_state_are_told_apart(spark, tmp_path, raw):
    m, days, _ = raw
    reduce, warm_up = REDUCERS["segments"]
    folder = lambda n: str(tmp_path / n)
    for part in (m.where(m["date"] != days[2]), m.where(m["date"] == days[2])):
        part.coalesce(1).write.mode("append").parquet(folder("raw"))
        stateful.refresh_stream(spark, folder("raw"), folder("cache"), folder("late"), folder("cp"), reduce, warm_up, m.schema)
    assert spark.read.parquet(folder("late")).drop("load_seq").exceptAll(m.where(m["date"] == days[2])).count() == 0
    assert spark.read.parquet(folder("late")).count() == m.where(m["date"] == days[2]).count()


@pytest.mark.parametrize("name", ["kinds", "segments"])
def test_pruned_refresh_equals_full(spark, tmp_path, raw, name):
    (m, days, late), (reduce, warm_up) = raw, REDUCERS[name]
    source, cache = str(tmp_path / "raw"), str(tmp_path / "cache")
    read = []
    for part in (m.where(m["date"].isin(days[:20]) & (m["entity"] != late)), m.where(m["date"].isin(days[20:22])), m.where((m["entity"] == late) & m["date"].isin(days[:20])), m.where(m["date"].isin(days[22:]))):
        part.repartition(1).write.mode("append").partitionBy("date").parquet(source)
        read.append(pruned.refresh_files(spark, source, cache, reduce, warm_up, m.schema))
    assert shown(incremental.current(spark, cache)) == shown(reduce(m))
    # two appended days need their partitions and those of their warm-up
    assert len(read[1]) <= 2 + warm_up and min(read[1]) >= str(days[20 - warm_up]) and len(read[3]) <= len(days[22:]) + warm_up
    assert pruned.refresh_files(spark, source, cache, reduce, warm_up, m.schema) == []


def test_the_scan_is_pruned_by_date(spark, tmp_path, raw, capsys):
    m, days, _ = raw
    m.repartition(1).write.partitionBy("date").parquet(str(tmp_path / "raw"))
    df = pruned.scan(spark, str(tmp_path / "raw"), m.schema, [str(d) for d in days[-3:]])
    df.explain("formatted")
    text = capsys.readouterr().out
    assert "PartitionFilters" in text and str(days[-1]) in text and str(days[0]) not in text
    assert df.select(F.input_file_name().alias("f")).distinct().count() == 3 < len(os.listdir(tmp_path / "raw"))
