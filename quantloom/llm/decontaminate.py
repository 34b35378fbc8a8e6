"""Benchmark decontamination with suffix arrays over training shards.

A shard is a run of documents of bounded size within a task. Its words that stand in some benchmark
item become ids, all others a break (a verbatim match can't cross them), and only stretches at least
as long as the shortest window are kept. A suffix array over what is left (rank doubling) is searched
for every benchmark suffix: the range of training suffixes that begin with it is narrowed word by word
by binary search. The range at the window's length gives all places; from them, and from the deepest range
that isn't empty, come the longest matches and where they stand. An item's suffixes are places in one
array of words, so memory grows with the block's text, however long an item is.

The benchmark is read in blocks of at most `block_bytes` of text, the only thing that is broadcast; a
larger benchmark takes more passes, merged by row.

Cases: null and empty documents have no words and no hits. Items without words, or without an id,
have no windows. An item of fewer words than the window is one window. Items of equal text count each.
Long texts are indexed whole. Repeated rows give repeated rows. Only id and text are read. An empty
table of documents or items gives an empty result or no hits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, in_batches, record_batch, slices

#: A-Z to lower case, other ASCII but digits and letters to a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
HITS = "n_words long, hits array<long>, items array<string>, matches array<struct<item_id:string,item_at:int,doc_at:long,length:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


class Vocabulary(dict):
    """Ids from 1; words outside of it are 0."""

    def __missing__(self, _: bytes) -> int:
        return 0


@dataclass
class Items:
    """One block of a benchmark: its words as ids, a 0 after each item, and the suffixes by where they start."""

    vocabulary: Vocabulary
    ids: list[str]
    words: np.ndarray
    #: of each suffix: its item, its place in words, its place in the item, its window's length
    owner: np.ndarray
    at: np.ndarray
    start: np.ndarray
    window: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[str, bytes]], window: int) -> Items:
        vocabulary = Vocabulary()
        texts = [(i, w) for i, t in rows if (w := words_of(t))]
        flat = np.fromiter((x for _, w in texts for x in (*(vocabulary.setdefault(y, len(vocabulary) + 1) for y in w), 0)), np.int32)
        n = np.array([len(w) for _, w in texts], np.int64)
        count = n - np.minimum(n, window) + 1
        owner = np.repeat(np.arange(len(n)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return cls(vocabulary, [i for i, _ in texts], flat, owner, (np.cumsum(n + 1) - n - 1)[owner] + start, start, np.minimum(n, window)[owner])


def suffix_array(seq: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of the suffixes' first `depth` values at least."""
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    k, most = 1, len(seq)
    while k < depth and rank.max() < most - 1:
        after = np.zeros(most, np.int64)
        after[: most - k] = rank[k:] + 1
        rank = np.unique(rank * (most + 1) + after, return_inverse=True)[1]
        k *= 2
    return np.argsort(rank, kind="stable")


def bound(value: Callable[[np.ndarray], np.ndarray], low: np.ndarray, high: np.ndarray, target: np.ndarray, right: bool) -> np.ndarray:
    """Binary search of each target in its own range of sorted values."""
    low, high = low.copy(), high.copy()
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) // 2
        at, goal = value(mid), target[open_]
        goes = at <= goal if right else at < goal
        low[open_[goes]] = mid[goes] + 1
        high[open_[~goes]] = mid[~goes]
    return low


@dataclass
class Found:
    """Suffixes that occur to their window's length: that range in the suffix array, and the longest match and one place of it."""

    rows: np.ndarray
    first: np.ndarray
    last: np.ndarray
    longest: np.ndarray
    place: np.ndarray


def search(seq: np.ndarray, sa: np.ndarray, items: Items) -> Found:
    """Narrows each benchmark suffix's range of training suffixes word by word, as far as any is left."""
    size = len(items.owner)
    rows, d = np.arange(size), 0
    low, high = np.zeros(size, np.int64), np.full(size, len(sa), np.int64)
    first, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
    longest = np.zeros(size, np.int64)
    while len(rows):
        target = items.words[items.at[rows] + d]
        rows, target = rows[target > 0], target[target > 0]
        value = lambda mid: seq[np.minimum(sa[mid] + d, len(seq) - 1)]  # noqa: B023, E731
        a = bound(value, low[rows], high[rows], target, False)
        b = bound(value, a, high[rows], target, True)
        found = b > a
        rows, a, b, d = rows[found], a[found], b[found], d + 1
        low[rows], high[rows], longest[rows] = a, b, d
        done = items.window[rows] == d
        first[rows[done]], last[rows[done]] = a[done], b[done]
    hit = np.flatnonzero(last > first)
    return Found(hit, first[hit], last[hit], longest[hit], sa[low[hit]])


def common_prefix(a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> np.ndarray:
    """Words from both places on that are equal, up to a stop."""
    length, open_ = np.zeros(len(at_a), np.int64), np.arange(len(at_a))
    while len(open_):
        x, y = a[at_a[open_] + length[open_]], b[at_b[open_] + length[open_]]
        open_ = open_[(x == y) & (x > 0)]
        length[open_] += 1
    return length


@dataclass
class Scan:
    block: Broadcast
    shard_bytes: int
    with_matches: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = self.block.value
        least = int(items.window.min(initial=1 << 30))
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.struct([("item_id", pa.string()), ("item_at", pa.int32()), ("doc_at", pa.int64()), ("length", pa.int32())]))]
        for b in slices(batches, max_bytes=self.shard_bytes):
            counts, runs = [], []
            for k, t in enumerate(b.column(1).cast(pa.binary()).to_pylist()):
                words = words_of(t)
                counts.append(len(words))
                ids = np.fromiter(map(items.vocabulary.__getitem__, words), np.int32, len(words))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], ids > 0, [0]])))
                for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                    if z - a >= least:
                        runs.append((k, a, ids[a:z]))
            yield record_batch([b.schema.names[0], "n_words", "hits", "items", "matches"], [b.schema.types[0], *types], [b.column(0), counts, *self.found(items, runs, len(counts))])

    def found(self, items: Items, runs: list, n: int) -> tuple[list, list, list]:
        hits, names, matches = [[] for _ in range(n)], [[] for _ in range(n)], [[] for _ in range(n)]
        if not runs:
            return hits, names, matches
        stop = np.zeros(1, np.int32)
        seq = np.concatenate([x for _, _, ids in runs for x in (ids, stop)])
        doc = np.concatenate([np.full(len(ids) + 1, k) for k, _, ids in runs])
        at = np.concatenate([np.arange(a, a + len(ids) + 1) for _, a, ids in runs])
        sa = suffix_array(seq, min(len(seq), int(np.diff(np.flatnonzero(items.words == 0), prepend=-1).max())))
        hit = search(seq, sa, items)
        rows, first, last = hit.rows, hit.first, hit.last
        n_each = last - first
        if not n_each.sum():
            return hits, names, matches
        row = np.repeat(rows, n_each)
        place = sa[np.repeat(first, n_each) + np.arange(n_each.sum()) - np.repeat(np.cumsum(n_each) - n_each, n_each)]
        inside = np.zeros(len(seq) + 1, np.int64)
        np.add.at(inside, place, 1)
        np.add.at(inside, place + items.window[row], -1)
        for p in np.flatnonzero(np.cumsum(inside)[:-1] > 0):
            hits[doc[p]].append(int(at[p]))
        for k, o in np.unique(np.stack([doc[place], items.owner[row]], 1), axis=0).tolist():
            names[k].append(items.ids[o])
        if self.with_matches:
            # Only where the match can't be longer to the left: diagonals of consecutive starts are one match.
            q = items.start[row]
            inner = (q > 0) & (place > 0) & (seq[np.maximum(place - 1, 0)] == items.words[np.maximum(items.at[row] - 1, 0)])
            row, place, q = row[~inner], place[~inner], q[~inner]
            length = common_prefix(seq, place, items.words, items.at[row])
            for o, b, p, n in zip(items.owner[row].tolist(), q.tolist(), place.tolist(), length.tolist(), strict=True):
                matches[doc[p]].append({"item_id": items.ids[o], "item_at": b, "doc_at": int(at[p]), "length": n})
        return hits, names, matches


@dataclass
class Clean:
    """Rows without hits, with all of their columns."""

    scan: Scan
    text: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text=self.text, max_bytes=self.scan.shard_bytes):
            two = pa.RecordBatch.from_arrays([pa.array(range(b.num_rows)), b.column(self.text)], names=["i", "text"])
            (found,) = self.scan(iter([two]))
            yield b.filter(pa.compute.equal(pa.compute.list_value_length(found.column(2)), 0))


def item_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> tuple[int, Iterator[Broadcast]]:
    """How many blocks there are, and each of them, broadcast when asked for."""
    items = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("string").alias("t")).where("i is not null and t is not null")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("t"))).first()[0] or 0) // block_bytes))

    def each() -> Iterator[Broadcast]:
        for k in range(blocks):
            part = items.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == k).orderBy("i").collect()
            yield benchmark.sparkSession.sparkContext.broadcast(Items.of([(r.i, r.t.encode()) for r in part], window))

    return blocks, each()


def scan(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = 16 << 20, block_bytes: int = 16 << 20, with_matches: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, hits (word positions in some window), items, and the maximal matches if asked for."""
    blocks, each = item_blocks(benchmark, window, block_bytes)
    narrow = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    if blocks > 1:
        rows = cut(docs.select(F.monotonically_increasing_id().alias("_row"), F.col(text_col).cast("string").alias("_text"), F.col(id_col).alias("_id")), "decontaminate")
        narrow = rows.select("_row", "_text")
    key = narrow.columns[0]
    schema = f"`{key}` {narrow.schema[0].dataType.simpleString()}, {HITS}"
    found = [in_batches(narrow, Scan(block, shard_bytes, with_matches), schema) for block in each]
    if blocks == 1:
        return found[0]
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    flat = lambda c: F.flatten(F.collect_list(c)).alias(c)
    merged = every.groupBy("_row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(flat("hits"))).alias("hits"), flat("items"), flat("matches"))
    return rows.select("_row", F.col("_id").alias(id_col)).join(merged, "_row").drop("_row")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated, and the longest verbatim match:

    its words, item and places in both (null without one; ties go to the first place, then the least item).
    """
    found = scan(docs, benchmark, id_col=id_col, with_matches=True, **options).withColumn("items", F.array_distinct("items"))
    ids = F.array_join(F.array_sort("items"), ",")
    best = F.array_min(F.transform("matches", lambda m: F.struct((-m["length"]).alias("n"), m["doc_at"].alias("doc_at"), m["item_id"].alias("item"), m["item_at"].alias("item_at"))))
    longest = ((-best["n"]).cast("long").alias("longest_match"), best["item"].alias("longest_item"), best["doc_at"].alias("longest_at"), best["item_at"].cast("long").alias("longest_item_at"))
    return found.select(id_col, "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"), *longest)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shard_bytes: int = 16 << 20, block_bytes: int = 16 << 20, text_col: str = "text") -> DataFrame:
    """The rows of docs in which no window of any item occurs, columns unchanged."""
    for block in item_blocks(benchmark, window, block_bytes)[1]:
        docs = in_batches(docs, Clean(Scan(block, shard_bytes, False), docs.columns.index(text_col)), docs.schema)
    return docs
