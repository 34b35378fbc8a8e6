"""N-gram Jaccard join with adaptive multi-match prefixes, up to connected components.

A document is the set of its n-word shingles, as 64-bit hashes. Under one global order of shingles, two
sets of sizes a and b whose Jaccard similarity reaches t share at least k of the first
size - ceil(t * size) + k shingles of each, for every k. Documents choose k by estimated cost: a longer
prefix reads more postings but asks for k shared shingles before a pair is verified. A pair needs the
smaller of its two k.

1. Equal sets are one class (its id is 128 bits of signature), so copies are never paired.
2. Prefixes with k a tenth of the set, under an order that needs no statistics (longer
   shingles first), show which classes share k prefix shingles with any others. The rest, most of a
   corpus, can have no link.
3. Only for these, all shingles are counted, ordered by frequency, and k is chosen.
4. Per shingle, each class is verified against one pivot, the class with the fewest rarer shingles.
   Links give first components.
5. Pairs that share enough prefix shingles and lie in different components are verified; links within
   a component can't change the result. Components of all links are final.

4 has one pair a posting. 5 has the pairs across components that share enough prefix shingles, with bounds
on sizes and positions in the join's condition: for classes that are close to each other, but not close
enough to link, these can be many, since nothing but a comparison tells such a pair from a link. All joins
are equi-joins that adaptive execution splits.

Cases: null and empty texts, and texts without words, have empty sets and link with nothing. Texts of
fewer words than a shingle are one shingle. Rows that repeat an id take part each by its own text. Rows
with null id link with nothing and have a null component. Long texts are used whole. Only id and
text are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, in_batches, record_batch, slices, worker_store
from .components import components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads all bits."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, and their lengths in bytes."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return np.empty(0, U), np.empty(0, np.int64)
    table = worker_store("shingles", "word hashes").setdefault("of", WordHashes())
    h = np.fromiter(map(table.__getitem__, words), U, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words))
    k = min(n, len(words))
    m = len(words) - k + 1
    out, length = np.full(m, U(k)), np.zeros(m, np.int64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * U(0x9E3779B97F4A7C15) + h[i : i + m])
            length += size[i : i + m]
    out, at = np.unique(out, return_index=True)
    return out, length[at]


def screen(size: int, percent: int) -> tuple[int, int]:
    """(slack, k): of the first slack + k shingles of a set with a link, k are shared at least."""
    slack = size - -(-percent * size // 100)
    return slack, min(-(-size // 10), size - slack)


@dataclass
class Sets:
    n: int
    percent: int
    whole: bool

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for b in slices(batches):
            sizes, ids, lists = [], [], []
            for t in b.column(1).cast(pa.binary()).to_pylist():
                h, length = shingles(t, self.n)
                with np.errstate(over="ignore"):
                    sums = np.array([mix(h + U(1)).sum(dtype=U), mix(h ^ U(0xA5A5A5A5A5A5A5A5)).sum(dtype=U) + U(len(h))], U)
                ids.append(mix(sums).tobytes())
                sizes.append(len(h))
                if not self.whole:
                    h = h[np.lexsort((h, -length))[: sum(screen(len(h), self.percent))]]
                lists.append(h.view(np.int64))
            names = [b.schema.names[0], b.schema.names[2], "size", "class", "tokens"]
            yield record_batch(names, [b.schema.types[0], b.schema.types[2], pa.int64(), pa.binary(), longs], [b.column(0), b.column(2), sizes, ids, pa.array(lists, longs)])


def needed(a: Column, b: Column, percent: int) -> Column:
    """Least overlap of sets of these sizes that reaches the similarity."""
    return F.ceil(percent * (a + b) / F.lit(100 + percent) - F.lit(1e-9))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that reach the similarity."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("size").alias(f"_n{x}"), F.col("tokens").alias(f"_t{x}"))
    both = F.size(F.array_intersect("_ta", "_tb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(100 * both >= percent * (F.col("_na") + F.col("_nb") - both)).select("a", "b")


def adaptive_prefixes(sets: DataFrame, percent: int, most: int, verify_cost: float) -> DataFrame:
    """One row a posting: token, class, size, pos (0 = rarest), k. Tokens of one class alone are left out."""
    rows = sets.select("class", "size", F.explode("tokens").alias("token"))
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    ranked = rows.join(counts, "token", "left").groupBy("class", "size").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("times", F.lit(1)).alias("times"), "token"))).alias("order"))
    slack = F.col("size") - F.ceil(F.col("size") * percent / F.lit(100.0) - F.lit(1e-9)).cast("long")
    # Reading the postings of a prefix costs their length; at most a k-th of them makes pairs to verify.
    read = lambda k: F.aggregate(F.slice("order", F.lit(1), (slack + k).cast("int")), F.lit(0).cast("long"), lambda s, x: s + x["times"] - 1)
    costs = F.array(*(F.struct((read(k) * (1 + verify_cost / k)).alias("cost"), F.lit(k).alias("k")) for k in range(1, most + 1)))
    k = F.least(F.array_min(costs)["k"], F.col("size").cast("int"))
    chosen = ranked.withColumn("k", k).select("class", "size", "k", F.posexplode(F.slice("order", F.lit(1), (slack + F.col("k")).cast("int"))).alias("pos", "_o"))
    return chosen.where("_o.times > 1").select(F.col("_o.token").alias("token"), "class", "size", "pos", "k")


@dataclass
class Classes:
    """first: a row each, of its class; classes: representatives; sets and lists: whole sets and prefixes of those that may link."""

    first: DataFrame
    classes: DataFrame
    sets: DataFrame
    lists: DataFrame


def close(a: dict[str, Column], b: dict[str, Column], percent: int) -> Column:
    """Bounds on sizes, and on the overlap that two postings' places leave."""
    return (100 * F.least(a["size"], b["size"]) >= percent * F.greatest(a["size"], b["size"])) & (F.least(a["size"] - a["pos"], b["size"] - b["pos"]) + F.least(a["k"], b["k"]) - 1 >= needed(a["size"], b["size"], percent))


def text_hash(c: Column) -> Column:
    return F.xxhash64(F.coalesce(c.cast("string"), F.lit("")))


def candidates(docs: DataFrame, n: int, percent: int, most: int, verify_cost: float, id_col: str, text_col: str) -> Classes:
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), text_hash(F.col(text_col)).alias("text_hash"))
    schema = f"doc_id {texts.schema[0].dataType.simpleString()}, text_hash long, size long, class binary, tokens array<long>"
    first = cut(in_batches(texts, Sets(n, percent, False), schema), "prefixes")
    linkable = first.where("doc_id is not null and size > 0")
    classes = linkable.groupBy("class").agg(F.min("doc_id").alias("rep"))

    single = cut(linkable.join(classes, (linkable["class"] == classes["class"]) & (linkable["doc_id"] == classes["rep"]), "left_semi").dropDuplicates(["class"]).select("doc_id", "size", "tokens"), "single")
    slack = F.col("size") - F.ceil(percent * F.col("size") / F.lit(100.0) - F.lit(1e-9))
    postings = single.select(F.col("doc_id").alias("rep"), F.least(F.ceil(F.col("size") / F.lit(10.0)), F.col("size") - slack).cast("int").alias("k"), F.explode("tokens").alias("token"))
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("token")
    alive = cut(postings.join(shared, "token", "left_semi").groupBy("rep", "k").agg(F.count(F.lit(1)).alias("times")).where("times >= k").select("rep").distinct(), "alive")

    sets = in_batches(texts.join(alive, texts["doc_id"] == alive["rep"], "left_semi"), Sets(n, percent, True), schema)
    sets = cut(sets.where("size > 0").select("class", "size", "tokens").dropDuplicates(["class"]), "sets")
    return Classes(first, classes, sets, cut(adaptive_prefixes(sets, percent, most, verify_cost), "lists"))


def sharing(lists: DataFrame, percent: int, more: Callable[[str, str], Column] | None = None) -> DataFrame:
    """Pairs of classes that share as many prefix shingles as the smaller k asks for."""
    x, y = lists.alias("x"), lists.alias("y")
    side = lambda s: {c: F.col(f"{s}.{c}") for c in ("pos", "size", "k")}
    on = (F.col("x.token") == F.col("y.token")) & (F.col("x.class") > F.col("y.class")) & close(side("x"), side("y"), percent)
    pairs = x.join(y, on if more is None else on & more("x", "y"))
    return pairs.groupBy(F.col("x.class").alias("a"), F.col("y.class").alias("b")).agg(F.count(F.lit(1)).alias("times"), F.min(F.least("x.k", "y.k")).alias("k")).where("times >= k").select("a", "b")


def class_links(docs: DataFrame, n: int = 5, percent: int = 80, most: int = 3, verify_cost: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All links between different texts: (class_id, linked_id) for both directions, and (id, class_id, n_links) a row.

    A class is the rows of equal sets and has its smallest id; n_links counts the classes it links with.
    """
    found = candidates(docs, n, percent, most, verify_cost, id_col, text_col)
    rep = lambda x: found.classes.select(F.col("class").alias(x), F.col("rep").alias(f"_r{x}"))
    one = cut(verified(sharing(found.lists, percent), found.sets, percent).join(rep("a"), "a").join(rep("b"), "b").select("_ra", "_rb"), "links")
    pairs = one.select(F.col("_ra").alias("class_id"), F.col("_rb").alias("linked_id")).unionByName(one.select(F.col("_rb").alias("class_id"), F.col("_ra").alias("linked_id")))
    times = pairs.groupBy("class_id").agg(F.count(F.lit(1)).alias("n_links"))
    of = found.classes.join(times, found.classes["rep"] == times["class_id"], "left").select(F.col("class").alias("_class"), F.col("rep").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    first = found.first
    rows = first.join(of, (first["class"] == of["_class"]) & (first["size"] > 0) & first["doc_id"].isNotNull(), "left")
    return pairs, rows.select(F.col("doc_id").alias(id_col), F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def linked(docs: DataFrame, n: int, percent: int, most: int, verify_cost: float, id_col: str, text_col: str) -> DataFrame:
    """Per row: doc_id, size, text_hash, component_id."""
    found = candidates(docs, n, percent, most, verify_cost, id_col, text_col)
    first, classes, sets, lists = found.first, found.classes, found.sets, found.lists
    posting = F.struct("pos", "class", "size", "k")
    pivots = lists.groupBy("token").agg(F.min(posting).alias("p"))
    near = lists.join(pivots, "token").where((F.col("class") != F.col("p.class")) & close({c: F.col(c) for c in ("pos", "size", "k")}, {c: F.col(f"p.{c}") for c in ("pos", "size", "k")}, percent))
    pairs = near.select(F.greatest("class", "p.class").alias("a"), F.least("class", "p.class").alias("b")).distinct()
    links = cut(verified(pairs, sets, percent), "links")
    roots = components(links)

    placed = lists.join(roots, lists["class"] == roots["node"], "left").select("token", "class", "size", "pos", "k", F.coalesce("root", "class").alias("root"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    open_ = cut(placed.join(mixed, "token", "left_semi"), "open")
    pairs = sharing(open_, percent, lambda x, y: F.col(f"{x}.root") != F.col(f"{y}.root"))
    more = cut(verified(pairs, sets, percent), "links")
    roots = components(links.unionByName(more)) if more.take(1) else roots

    of_class = classes.join(roots, classes["class"] == roots["node"], "left").select(classes["class"].alias("class"), "rep", F.coalesce("root", classes["class"]).alias("root"))
    of_class = cut(of_class, "classes")
    least = of_class.groupBy("root").agg(F.min("rep").alias("component_id"))
    member = of_class.join(least, "root").select(F.col("class").alias("_class"), "component_id")
    out = first.join(member, (first["class"] == member["_class"]) & (first["size"] > 0) & first["doc_id"].isNotNull(), "left")
    return out.select("doc_id", "size", "text_hash", F.coalesce("component_id", "doc_id").alias("component_id"))


def link_components(docs: DataFrame, n: int = 5, percent: int = 80, most: int = 3, verify_cost: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links of at least percent/100)."""
    return linked(docs, n, percent, most, verify_cost, id_col, text_col).select(F.col("doc_id").alias(id_col), F.col("size").alias("n_shingles"), "component_id")


def drop_near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, most: int = 3, verify_cost: float = 4.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component: that with the smallest id, of equal ids one text.

    Rows that repeat both id and text are one document and stay or go together.
    """
    rows = linked(docs, n, percent, most, verify_cost, id_col, text_col).where("size > 0 and doc_id is not null")
    rows = cut(rows, "members")
    kept = rows.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    gone = rows.join(kept, "component_id").where(F.struct("doc_id", "text_hash") != F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("text_hash").alias("_gone_hash")).distinct()
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_d"), F.col(id_col).alias("_id"), text_hash(F.col(text_col)).alias("_h"))
    gone = cut(gone, "gone")
    left = whole.join(gone, (whole["_id"] == gone["_gone"]) & (whole["_h"] == gone["_gone_hash"]), "left_anti")
    return left.select(*(F.col("_d")[c].alias(c) for c in docs.columns))
