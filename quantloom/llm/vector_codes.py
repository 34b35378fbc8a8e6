"""Vector codes: one codebook a part of the vector, learnt by Yinyang's form of Lloyd's rounds.

A component x becomes floor(scale * x); a vector is cut into equal parts, and each part has a codebook of
its own. Entries of a codebook are clustered into groups once. A row carries, by part, its entry and one
lower bound a group: no entry of the group but its own is nearer. After an update a group's bound sinks by
the largest move of its entries; only groups whose bound no longer exceeds the distance to the row's own
entry are scanned, by one matrix product for all rows of a batch that need it. Distances that decide are
integers, so ties are exact and go to the lower index; bounds are floats that are rounded to the safe side.

Rows and their bounds are a table in the shared folder, written anew each round; codebooks (parts x entries
vectors, whatever the table's size) are all that the driver and the tasks hold. Sums of a round combine
within each task first.

Cases: rows whose vector is null, or holds null, NaN or infinity, are dropped. The dimension is that of the
smallest id among vectors that the parts divide; vectors of another dimension, and those with a component so large that
squared distances may not fit a long, have null code and error and no say in codebooks. Rows that repeat an id
stay; of equal ids the smaller vector comes first in the codebook; null ids come last. With fewer rows than
entries the codebook is as short. label_error adds what is not null; it is null where nothing is. Only id, vector
and label are read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from .common import cut, in_batches, owned

NONE = np.iinfo(np.int64).max


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows and entries. By floats while each sum is an exact one, else by integers."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * largest * largest < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x - e) ** 2).sum(1) for e in entries], 1)


def grouped(entries: np.ndarray, groups: int, rounds: int = 5) -> np.ndarray:
    """A group for each entry, near ones together. Any grouping gives the same codes."""
    if len(entries) <= groups:
        return np.arange(len(entries))
    e = entries.astype(np.float64)
    centres = e[np.linspace(0, len(e) - 1, groups).astype(int)]
    for _ in range(rounds):
        of = ((e[:, None] - centres) ** 2).sum(2).argmin(1)
        centres = np.stack([e[of == g].mean(0) if (of == g).any() else centres[g] for g in range(groups)])
    return of


@dataclass
class Book:
    """One part's entries, their groups, and how far each group's entries moved at most since bounds were kept."""

    entries: np.ndarray
    group: np.ndarray
    moved: np.ndarray

    @property
    def groups(self) -> int:
        return len(self.moved)

    def updated(self, sums: dict[int, tuple[int, list[int]]]) -> Book:
        new = self.entries.copy()
        for j, (n, total) in sums.items():
            new[j] = [t // n for t in total]
        moves = np.sqrt(((new - self.entries) ** 2).sum(1).astype(np.float64))
        moved = np.array([moves[self.group == g].max(initial=0.0) for g in range(self.groups)])
        return Book(new, self.group, moved)

    def assign(self, x: np.ndarray, code: np.ndarray | None, bounds: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Entry, squared distance and new bounds of each row."""
        n, rows = len(x), np.arange(len(x))
        if code is None:
            code, own = np.full(n, NONE), np.full(n, NONE)
            low, scan = np.zeros((n, self.groups)), np.ones((n, self.groups), bool)
        else:
            own = ((x - self.entries[code]) ** 2).sum(1)
            upper = np.sqrt(own.astype(np.float64))
            low = bounds.astype(np.float64) - self.moved
            scan = low <= (upper + (upper + 1) * 1e-9)[:, None]
        least, least_at, next_least = (np.full((n, self.groups), NONE) for _ in range(3))
        for g in range(self.groups):
            of, asked = np.flatnonzero(self.group == g), np.flatnonzero(scan[:, g])
            if not len(of) or not len(asked):
                continue
            d = squares(x[asked], self.entries[of])
            at, of_asked = d.argmin(1), np.arange(len(asked))
            least[asked, g], least_at[asked, g] = d[of_asked, at], of[at]
            d[of_asked, at] = NONE
            next_least[asked, g] = d.min(1)
        found = least.min(1)
        found_at = np.where(least == found[:, None], least_at, NONE).min(1)
        stays = (own < found) | ((own == found) & (code <= found_at))
        new, error = np.where(stays, code, found_at), np.where(stays, own, found)
        # The bound leaves out the row's own entry: where that is a group's nearest, the second counts.
        seen = np.sqrt(np.where(least_at == new[:, None], next_least, least).astype(np.float64))
        seen[np.where(least_at == new[:, None], next_least, least) == NONE] = np.inf
        kept = low.copy()
        left = (new != code) & (code != NONE)
        if left.any():
            r = rows[left]
            g = self.group[code[left]]
            kept[r, g] = np.minimum(kept[r, g], np.sqrt(own[left].astype(np.float64)))
        safe = np.where(scan, seen, kept) * (1 - 1e-9) - 1e-9
        return new, error, np.nextafter(safe.astype(np.float32), np.float32(-np.inf))


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


@dataclass
class Assign:
    """Rows (id, label, x, code, bounds) with a new code and bounds; at the end with code as hex and the error."""

    books: Broadcast
    schema: pa.Schema
    last: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            books: list[Book] = self.books.value
            x, known = matrix(b.column(2), np.int64), b.num_columns > 3
            parts = np.split(x, len(books), 1)
            codes = matrix(b.column(3), np.int64) if known else [None] * len(books)
            starts = np.cumsum([0, *(k.groups for k in books)])
            bounds = matrix(b.column(4), np.float32) if known else None
            out = [k.assign(p, codes[:, i] if known else None, bounds[:, starts[i] : starts[i + 1]] if known else None) for i, (k, p) in enumerate(zip(books, parts, strict=True))]
            code = np.stack([c for c, _, _ in out], 1)
            if self.last:
                columns = [b.column(0), b.column(1), [r.tobytes().hex() for r in code.astype(np.uint8)], sum(e for _, e, _ in out)]
            else:
                low = np.concatenate([w for _, _, w in out], 1)
                columns = [b.column(0), b.column(1), b.column(2), listed(code.astype(np.int32)), listed(low)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def listed(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel()))


@dataclass
class Sums:
    """Of (x, code): count and sums by part and entry, combined within a task."""

    entries: int
    parts: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            x, code = matrix(b.column(0), np.int64), matrix(b.column(1), np.int64)
            if total is None:
                total, n = np.zeros((self.parts, self.entries, x.shape[1] // self.parts), np.int64), np.zeros((self.parts, self.entries), np.int64)
            for p, y in enumerate(np.split(x, self.parts, 1)):
                order = np.argsort(code[:, p], kind="stable")
                at, first = np.unique(code[order, p], return_index=True)
                total[p, at] += np.add.reduceat(y[order], first, 0)
                n[p] += np.bincount(code[:, p], minlength=self.entries)
        if total is not None:
            p, j = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(j), pa.array(n[p, j]), listed(total[p, j])], names=["part", "entry", "n", "total"])


def vector_codes(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, groups: int = 16, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, code, error, label_error, codebooks_sha256 of each row whose vector is finite."""
    if entries > 256:
        raise ValueError("an entry's index has two hex digits")
    spark = vectors.sparkSession
    v = F.col("v")
    finite = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # (2 * component)^2 * dimension stays below 2^63.
    fits = F.forall(v, lambda x: F.abs(x) * scale < 2.0**30.5 / F.sqrt(F.size(v)) - 1)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")).where(finite)
    x = F.when(fits & (F.size(v) > 0) & (F.size(v) % parts == 0), F.transform(v, lambda x: F.floor(x * scale).cast("long")))
    rows = rows.select("id", "label", x.alias("x"))
    ranked = [F.col("id").asc_nulls_last(), F.col("x")]
    first = rows.where("x IS NOT NULL").orderBy(*ranked).select(F.size("x").alias("n")).first()
    dim = first.n if first else parts
    usable = rows.where(F.size("x") == dim)
    start = np.array([r.x for r in usable.orderBy(*ranked).select("x").limit(entries).collect()], np.int64).reshape(-1, dim)
    books = [Book(p, of := grouped(p, groups), np.zeros(of.max(initial=-1) + 1)) for p in np.split(start, parts, 1)]

    ids = rows.schema["id"].dataType, rows.schema["label"].dataType
    named = [StructField("id", ids[0]), StructField("label", ids[1])]
    state = StructType([*named, StructField("x", ArrayType(LongType())), StructField("code", ArrayType(IntegerType())), StructField("bounds", ArrayType(FloatType()))])
    ended = StructType([*named, StructField("code", StringType()), StructField("error", LongType())])
    now, owner = usable, f"codes {uuid.uuid4().hex}"
    for r in range(rounds + 1) if len(start) else ():
        last = r == rounds
        step = Assign(spark.sparkContext.broadcast(books), arrow(ended if last else state), last)
        assigned = in_batches(now, step, ended if last else state)
        if last:
            with owned(owner):
                now = cut(assigned, "codes")
            break
        with owned(owner):
            now = cut(assigned, "bounds")
        found: list[dict] = [{} for _ in books]
        partial = in_batches(now.select("x", "code"), Sums(len(start), parts), "part long, entry long, n long, total array<long>")
        for s in partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(dim // parts))).collect():
            found[s.part][s.entry] = s.n, list(s[3:])
        books = [k.updated(f) for k, f in zip(books, found, strict=True)]
        with owned(owner, spark, now):
            pass  # tables of earlier rounds go
    if not len(start):
        now = spark.createDataFrame([], ended)
    digest = hashlib.sha256(",".join(str(c) for k in books for e in k.entries for c in e).encode()).hexdigest()
    others = rows.where(F.coalesce(F.size("x") != dim, F.lit(True))).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = now.unionByName(others)
    by_label = now.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    full = coded.join(by_label, F.col("label").eqNullSafe(F.col("_label")), "left")
    return full.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
