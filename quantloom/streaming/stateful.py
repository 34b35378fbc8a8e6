"""Refresh as a stream: each entity's last days are state, so a new day meets its warm-up without a look at history.

A file stream of minute rows is grouped by entity. The state holds the entity's last `warm_up + provisional` days, each as one Arrow
payload. Rows of a new day, or of a day among the last `provisional` ones, are merged into it, and that day and all days behind it
go on together with the warm-up days before them. The batch reduces these with the same function as a full
recompute and writes the fresh days under the batch's number, which a batch that is run again overwrites. `stored` reads of each
entity and day what was written last. Rows too old for the state's days go to `late`, for `incremental.correct`.

Cases: an entity seen first starts with what it has, in whatever order its days come, until days are dropped. Rows with a null entity or date are dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StructType

from ..operators.steps import keep_last
from ..shipping import ship

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastDays(StatefulProcessor):
    def __init__(self, warm_up: int, provisional: int, columns: list[str]):
        self.warm_up, self.provisional, self.columns = warm_up, provisional, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "date date", "rows binary")
        # Whether days have been dropped: before that the first days need no warm-up.
        self.full = handle.getValueState("full", "full boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        held = {k[0] for k in self.days.keys()}
        dropped = self.full.exists()
        usable = []
        for d, part in new.groupby("date", sort=True):
            if dropped and sum(h < d for h in held) < self.warm_up:
                yield self.marked(part, None)
                continue
            before = [unpacked(self.days.getValue((d,))[0])] if d in held else []
            self.days.updateValue((d,), (packed(pd.concat([*before, part], ignore_index=True)),))
            held.add(d)
            usable.append(d)
        if not usable:
            return
        order = sorted(held)
        first = order.index(min(usable))
        for k, d in enumerate(order[max(0, first - self.warm_up) :], max(0, first - self.warm_up)):
            yield self.marked(unpacked(self.days.getValue((d,))[0]), k >= first)
        for d in order[: max(0, len(order) - self.warm_up - self.provisional)]:
            self.days.removeKey((d,))
            self.full.update((True,))

    def marked(self, rows: pd.DataFrame, fresh: bool | None) -> pd.DataFrame:
        return rows[self.columns].assign(fresh=pd.Series([fresh] * len(rows), index=rows.index, dtype="boolean"))

    def close(self) -> None:
        pass


def packed(rows: pd.DataFrame) -> bytes:
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_all().to_pandas()


def refresh_stream(spark: SparkSession, raw: str, cache: str, late: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame], warm_up: int, schema: StructType, provisional: int = 1) -> None:
    """Drains the folder's new files into the cache; the checkpoint carries state and place from call to call."""
    ship(spark)
    spark.conf.set(PROVIDER, ROCKS)  # the only store for this kind of state
    marked = StructType([*schema.fields]).add("fresh", BooleanType())
    rows = spark.readStream.schema(schema).parquet(raw).where("entity IS NOT NULL AND date IS NOT NULL")
    days = rows.groupBy("entity").transformWithStateInPandas(LastDays(warm_up, provisional, schema.names), marked, "append", "none")

    def put(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()
        made = reduce(held.where("fresh IS NOT NULL").drop("fresh"))
        fresh = held.where("fresh").select("entity", "date").distinct()
        made.join(fresh, ["entity", "date"], "left_semi").write.mode("overwrite").parquet(f"{cache}/load_seq={epoch}")
        held.where("fresh IS NULL").drop("fresh").write.mode("overwrite").parquet(f"{late}/load_seq={epoch}")
        held.unpersist()

    days.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stored(spark: SparkSession, cache: str) -> DataFrame:
    """Of each entity and day the row of the highest batch."""
    every = spark.read.parquet(cache).withColumn("load_seq", F.col("load_seq").cast("long"))
    return keep_last(every, ["entity", "date"], ["load_seq"]).drop("load_seq")
