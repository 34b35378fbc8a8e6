"""The remote source: filters reach the client, transient errors are tried again, a failed read returns nothing."""

import datetime
import os
import sys
import uuid

import pytest
from pyspark import cloudpickle

from quantloom.sources import remote

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAYS = [datetime.date(2024, 1, 1) + datetime.timedelta(days=i) for i in range(10)]


class Flaky:
    """Every batch fails `failures` times; calls are noted in a folder, as tasks run in other processes."""

    def __init__(self, folder, failures=0, error=remote.TransientError):
        self.folder, self.failures, self.error = str(folder), failures, error

    def ids(self):
        return [f"e{k:02d}" for k in range(11)]

    def fetch(self, ids, fields, start, end):
        before = [f for f in os.listdir(self.folder) if f.startswith(ids[0])]
        open(f"{self.folder}/{ids[0]}-{len(ids)}-{start}-{end}-{uuid.uuid4().hex}", "w").close()
        if len(before) < self.failures:
            raise self.error("try later")
        days = [d for d in DAYS if (start is None or d >= start) and (end is None or d <= end)]
        return [(i, d, *(float(len(f) + d.day) for f in fields)) for i in ids for d in days]


def calls(folder):
    return sorted(f.rsplit("-", 1)[0] for f in os.listdir(folder))


def test_one_partition_a_batch(spark, tmp_path):
    remote.register(spark, "whole", Flaky(tmp_path))
    df = remote.fields(spark, "whole", ["close", "vol"], batchSize=4)
    assert df.schema.simpleString() == "struct<entity:string,date:date,close:double,vol:double>"
    assert df.rdd.getNumPartitions() == 3 and df.count() == 110
    assert {r.vol - r.date.day for r in df.collect()} == {3.0}


def test_filters_reach_the_client(spark, tmp_path):
    remote.register(spark, "pushed", Flaky(tmp_path))
    df = remote.fields(spark, "pushed", ["x"], batchSize=4).where("date > '2024-01-03' AND date <= '2024-01-05' AND entity IN ('e02', 'e09', 'zz') AND x > 0")
    assert sorted((r.entity, r.date.day) for r in df.collect()) == [("e02", 4), ("e02", 5), ("e09", 4), ("e09", 5)]
    assert calls(tmp_path) == ["e02-2-2024-01-04-2024-01-05"]
    none = remote.fields(spark, "pushed", ["x"]).where("date > '2024-02-01' AND date < '2024-01-05'")
    assert none.count() == 0 and len(calls(tmp_path)) == 1


def test_transient_errors_are_tried_again(spark, tmp_path):
    remote.register(spark, "flaky", Flaky(tmp_path, failures=2))
    assert remote.fields(spark, "flaky", ["x"], batchSize=6, waitSeconds=0.01).count() == 110
    assert len(calls(tmp_path)) == 6


@pytest.mark.parametrize(("error", "tries", "most"), [(ValueError, 5, 1), (remote.TransientError, 3, 3)])
def test_a_failing_batch_fails_the_read(spark, tmp_path, error, tries, most):
    class OneBad(Flaky):
        def fetch(self, ids, fields, start, end):
            self.failures = 99 if "e05" in ids else 0
            return super().fetch(ids, fields, start, end)

    remote.register(spark, f"bad{most}", OneBad(tmp_path, error=error))
    with pytest.raises(Exception, match="try later"):
        remote.fields(spark, f"bad{most}", ["x"], batchSize=5, tries=tries, waitSeconds=0.01).write.parquet(str(tmp_path / "out"))
    assert len([c for c in calls(tmp_path) if c.startswith("e05")]) == most
    assert not (tmp_path / "out" / "_SUCCESS").exists()
