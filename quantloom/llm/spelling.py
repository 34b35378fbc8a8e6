"""Spelling variants: pairs of words one edit apart from merged errata tries, and each word's form and root.

The trie of all words is cut into heavy paths: at each node the child with most words is heavy, the others and
the end of a word there are light. Two words one edit apart part at one node, and one of them at least goes on
by a light edge. So at each node the light subtrees alone are moved, small into large: their words with the next character
skipped, replaced by the heavy one, or set behind the heavy one are looked up among all words, and light words
whose rests after the skipped character coincide at a node are one replacement apart. A word lies in at
most log2(words) light subtrees, so it is moved that often, not once a character. Each pair comes up once.

Tries, moves and look-ups are rows, keyed by nodes or by whole words. The `hot` nodes with most words are
broadcast (their number is the bound); other nodes and words meet by shuffles. Light words that coincide at a node differ in
one character, so a group is as large as the alphabet at most and gives its members their count and best
partner without its pairs. A root is found by doubling: forms grow tenfold a step, so steps are few.

Cases: null and empty texts have no words. A null id stands as an empty text where words are spelt anew. Repeated rows
count each time. Long words are rows of a fixed size until they are moved. Of equally frequent near words the first in code-point order is the form. Long texts are read whole. Only id
and text are read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, in_batches, owned, record_batch, slices

RUN = "[A-Za-zÀ-ÿ]{%d,}"


def vocabulary(docs: DataFrame, least_chars: int = 7, least_n: int = 2, every: int = 31, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the distinct lower-cased letter runs, of which each `every`th by a hash has lost a character."""
    # Shorter runs can't become words, and a run of enough letters is matched whole.
    found = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(RUN % least_chars), F.lit(0))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    run = F.col("run")
    runs = runs.select("id", F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(ascii_lower(run)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length(run)).cast("int")
    word = F.when(h % every == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)
    return runs.select(word.alias("word")).where(F.length("word") >= least_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_n)


@dataclass
class DeepSteps:
    """Of (key, n, word): (key, n, at, node, char) behind the first `depth` characters. Nodes are rolling hashes of prefixes."""

    depth: int

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text=2):
            for key, n, word in zip(*(c.to_pylist() for c in b.columns), strict=True):
                node, rows = 0, []
                for at, char in enumerate(chain(word, ("",))):
                    if at > self.depth:
                        rows.append((key, n, at, node, char))
                    if len(rows) == 50_000:
                        yield stepped(rows)
                        rows = []
                    node = (node * 1_000_003 + ord(char)) % ((1 << 61) - 1) if char else node
                yield stepped(rows)


def stepped(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    return record_batch(["key", "n", "at", "node", "char"], types, list(zip(*rows, strict=True)) or [[]] * 5)


def light_edges(words: DataFrame, hot: int = 1000, depth: int = 64) -> DataFrame:
    """word, n, prefix, char, rest, heavy: for each node where the word leaves the heavy path; char is empty where it ends.

    A node is a hash of its prefix, so a long word takes rows of a fixed size. Two prefixes of one hash
    share a heavy child, which may cost moves but no pair: any child may be taken for the heavy one. Behind `depth`
    characters only words go on that share so many with another.
    """
    at, word = F.col("at"), F.col("word")
    # Words have letters only.
    keyed = words.select("word", "n", F.when(F.length("word") <= depth, word).otherwise(F.concat(F.lit(":"), F.sha2("word", 256))).alias("key"))
    steps = keyed.select("key", "n", "word", F.explode(F.sequence(F.lit(0), F.least(F.length("word"), F.lit(depth)))).alias("at"))
    steps = steps.select("key", "n", "at", F.xxhash64(word.substr(F.lit(1), at)).alias("node"), word.substr(at + 1, F.lit(1)).alias("char"))
    long = keyed.where(F.length("word") > depth).withColumn("start", word.substr(F.lit(1), F.lit(depth + 1)))
    shared = long.groupBy("start").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("start")
    deep = in_batches(long.join(shared, "start", "left_semi").select("key", "n", "word"), DeepSteps(depth), "key string, n long, at int, node long, char string")
    steps = steps.unionByName(deep)
    children = steps.where("char <> ''").groupBy("node", "char").agg(F.count(F.lit(1)).alias("size"))
    ends = steps.where("char = ''").select("node", "char", F.lit(1).cast("long").alias("size"))
    both = children.unionByName(ends)
    nodes = both.groupBy("node").agg(F.max_by("char", F.when(F.col("char") != "", F.struct("size", "char"))).alias("heavy"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("children"))
    nodes = cut(nodes.where("children > 1 AND heavy IS NOT NULL").select("node", "heavy", "size"), "nodes")
    often = nodes.orderBy(F.desc("size"), "node").limit(hot).select("node", F.col("heavy").alias("_heavy"))
    known = steps.join(F.broadcast(often), "node", "left")
    near = known.where("char <> _heavy").withColumnRenamed("_heavy", "heavy")
    far = known.where("_heavy IS NULL").drop("_heavy").join(nodes.select("node", "heavy"), "node").where("char <> heavy")
    light = near.unionByName(far).select("key", "n", "at", "char", "heavy")
    short = light.where(~F.col("key").startswith(":")).withColumnRenamed("key", "word")
    others = light.where(F.col("key").startswith(":")).join(keyed.where(F.length("word") > depth).select("key", "word"), "key").drop("key")
    found = short.unionByName(others)
    return found.select("word", "n", word.substr(F.lit(1), at).alias("prefix"), "char", word.substr(at + 2, F.length(word)).alias("rest"), "heavy")


def moved(light: DataFrame) -> DataFrame:
    """word, n, other: what the word becomes by each of the three moves at a light edge."""
    char, rest = F.col("char"), F.col("rest")
    replaced = F.when(char != "", F.concat("prefix", "heavy", "rest"))
    inserted = F.concat("prefix", "heavy", "char", "rest")
    # Where the next character is the same the pair parts further down.
    skipped = F.when((char != "") & ~rest.startswith(char), F.concat("prefix", "rest"))
    return light.select("word", "n", F.explode(F.array(replaced, inserted, skipped)).alias("other")).where("other IS NOT NULL")


def coinciding(light: DataFrame) -> DataFrame:
    """group: light words (m = -n, word) of a node that are equal but for its character, best first."""
    group = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), "word")))
    return light.where("char <> ''").groupBy("prefix", "rest").agg(group.alias("group")).where("size(group) > 1").select("group")


def met(words: DataFrame, light: DataFrame) -> DataFrame:
    """word, n, other, other_n: pairs found by looking moved words up."""
    return moved(light).join(words.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")


def one_edit_pairs(words: DataFrame, hot: int = 1000) -> DataFrame:
    """a < b: each pair of words that one inserted, deleted or replaced character parts, once."""
    light = cut(light_edges(words, hot), "light")
    left, right = F.posexplode("group").alias("i", "a"), F.explode(F.expr("slice(group, i + 2, size(group))")).alias("b")
    pairs = coinciding(light).select("group", left).select("a.word", right).select(F.col("word").alias("a"), F.col("b.word").alias("b"))
    both = met(words, light).select(F.col("word").alias("a"), F.col("other").alias("b")).unionByName(pairs)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def near_words(words: DataFrame, hot: int = 1000) -> DataFrame:
    """word, n_near, best (m = -n, word): how many words are near, and the most frequent of them."""
    light = cut(light_edges(words, hot), "light")

    def partner(n: str, word: str) -> Column:
        return F.struct((-F.col(n)).alias("m"), F.col(word).alias("word")).alias("best")

    pairs = met(words, light)
    found = [pairs.select("word", F.lit(1).alias("k"), partner("other_n", "other")), pairs.select(F.col("other").alias("word"), F.lit(1).alias("k"), partner("n", "word"))]
    members = coinciding(light).select(F.posexplode("group").alias("i", "own"), (F.size("group") - 1).alias("k"), F.col("group")[0].alias("first"), F.col("group")[1].alias("second"))
    found.append(members.select("own.word", "k", F.when(F.col("i") == 0, F.col("second")).otherwise(F.col("first")).alias("best")))
    return found[0].unionByName(found[1]).unionByName(found[2]).groupBy("word").agg(F.sum("k").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the forms that each word with a form leads to."""
    now = cut(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(further, "root", "left_semi").isEmpty():
            return now
        now = cut(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(docs: DataFrame, times: int = 10, least_chars: int = 7, least_n: int = 2, every: int = 31, hot: int = 1000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n, n_near, form, form_n, root: each word, its near words, and where it leads."""
    with owned(f"spelling {uuid.uuid4().hex}"):
        words = cut(vocabulary(docs, least_chars, least_n, every, id_col, text_col), "words")
        near = words.join(near_words(words, hot), "word", "left")
        is_form = -F.col("best.m") >= F.col("n") * times
        named = cut(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
        return named.join(roots(named.where("form IS NOT NULL")), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
