"""A remote service of daily fields as a Spark data source: one partition a batch of ids, filters pushed down.

    remote.register(spark, "desk", client)
    spark.read.format("desk").option("fields", "close,volume").load().where("date >= '2024-01-01' AND entity IN ('a', 'b')")

A client is any object that pickles, with `ids()` and `fetch(ids, fields, start, end)`; fetch returns rows (entity, date, *fields) and takes
None for an open end. Filters on entity and date reach the client: only batches with asked ids become partitions, and only asked days are fetched.
A transient error is tried again within the partition, after waits that double; any other error, or too many
of these, fails the task and, once Spark has run that again, the whole read. No part of a failed read is returned.
"""

from __future__ import annotations

import datetime
import random
import time
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..shipping import ship

DAY = datetime.timedelta(days=1)
PUSH_DOWN = "spark.sql.python.filterPushdown.enabled"


class TransientError(Exception):
    """Worth another try: a time-out, a refused connection, a rate limit."""


class Client(Protocol):
    def ids(self) -> Iterable[str]: ...

    def fetch(self, ids: list[str], fields: list[str], start: datetime.date | None, end: datetime.date | None) -> Iterable[tuple]: ...


@dataclass
class Batch(InputPartition):
    ids: list[str]
    start: datetime.date | None
    end: datetime.date | None


def later(a: datetime.date | None, b: datetime.date) -> datetime.date:
    return b if a is None else max(a, b)


def earlier(a: datetime.date | None, b: datetime.date) -> datetime.date:
    return b if a is None else min(a, b)


class Reader(DataSourceReader):
    def __init__(self, client: Client, options: dict[str, str]):
        self.client = client
        self.fields = field_names(options)
        self.size, self.tries, self.wait = int(options.get("batchSize", 500)), int(options.get("tries", 5)), float(options.get("waitSeconds", 1.0))
        self.asked: set[str] | None = None
        self.start: datetime.date | None = None
        self.end: datetime.date | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            match f:
                case EqualTo(("entity",), value) if value is not None:
                    self.only({value})
                case In(("entity",), values):
                    self.only(set(values) - {None})
                case EqualTo(("date",), value) if value is not None:
                    self.start, self.end = later(self.start, value), earlier(self.end, value)
                case GreaterThanOrEqual(("date",), value):
                    self.start = later(self.start, value)
                case GreaterThan(("date",), value):
                    self.start = later(self.start, value + DAY)
                case LessThanOrEqual(("date",), value):
                    self.end = earlier(self.end, value)
                case LessThan(("date",), value):
                    self.end = earlier(self.end, value - DAY)
                case _:
                    yield f

    def only(self, ids: set[str]) -> None:
        self.asked = ids if self.asked is None else self.asked & ids

    def partitions(self) -> list[Batch]:
        ids = sorted({i for i in self.client.ids() if self.asked is None or i in self.asked})
        if self.start and self.end and self.start > self.end:
            ids = []
        # Spark wants a partition; one without ids fetches nothing.
        return [Batch(ids[i : i + self.size], self.start, self.end) for i in range(0, len(ids), self.size)] or [Batch([], None, None)]

    def read(self, partition: Batch) -> Iterator[tuple]:
        if not partition.ids:
            return iter(())
        for k in range(self.tries):
            try:
                # A batch is taken whole before any row of it goes on.
                return iter([tuple(r) for r in self.client.fetch(partition.ids, self.fields, partition.start, partition.end)])
            except TransientError:
                if k + 1 == self.tries:
                    raise
                time.sleep(self.wait * 2**k * (1 + random.random() / 4))
        raise AssertionError("tries must be positive")


def field_names(options: dict[str, str]) -> list[str]:
    return [x.strip() for x in options.get("fields", "").split(",") if x.strip()]


def register(spark: SparkSession, name: str, client: Client) -> None:
    """Makes `spark.read.format(name)` read this client."""
    ship(spark)

    class Remote(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return ", ".join(["entity string", "date date", *(f"`{f}` double" for f in field_names(self.options))])

        def reader(self, schema) -> Reader:
            return Reader(client, self.options)  # keys without regard to case

    spark.dataSource.register(Remote)
    spark.conf.set(PUSH_DOWN, "true")


def fields(spark: SparkSession, name: str, wanted: list[str], **options) -> DataFrame:
    """A registered source's table of these fields."""
    return spark.read.format(name).options(fields=",".join(wanted), **options).load()
