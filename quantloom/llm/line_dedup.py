"""Line dedup by content-defined chunks, in DataFrame functions only.

Lines are hashed, and a rolling hash goes over every two of them. The place between two lines is a
boundary if its rolling hash is the smallest of some `spacing` places in a row, or if the two lines hold
at least `min_words` words: that depends on the lines around it alone, so boundaries move with the text,
and no `spacing` places lack one. A chunk is all lines from one boundary to the next (a text's start and
end are boundaries too); chunks of several lines, and lines of at least `min_words` words, are compared
over the corpus. The two lines at a boundary, its seam, are compared too: they tie a chunk to the next
one, and meet repetitions that hold a boundary but no whole chunk. From every repeated seam the
repetition is followed outwards, line by line on both sides, up to the most lines that a chunk may have:
there the next common boundary takes over, so that it ends where the repetition ends.

So any passage of more than `spacing` lines holds a boundary, the same in all documents, and is covered
to its first and last line, as is any of two lines and `min_words` words. Larger spacing makes longer
chunks and fewer rows, and misses more of the passages that are shorter than it.

Units that occur more than once in the corpus are found by hash, then grouped by their bytes; a line
outwards is grouped by its bytes and a digest of 128 bits of those between it and the seam, the seam
included. All but the first occurrence, in order of document and line, are removed; the first one stays.

Hashes travel without text; text is sent for repeated units only, and counts combine before the
shuffle, so a passage that a third of all rows share is one row a task. The most frequent units, a
bounded number of bounded size, reach their occurrences by broadcast, all others by equi-joins that
adaptive execution splits. The earliest occurrence of every line stays somewhere.

Cases: null text stays null, empty text empty. Rows that repeat both id and text are one document and
keep the same lines. A line includes the blank lines behind it, and is removed with them. Long
texts are handled line by line. Other columns pass through whatever their names; `n_chars`, where
there is one, is set anew for changed texts. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

WORDS = r"[^\x20\x09-\x0D]+"
#: A line feed before a line that isn't blank.
NEXT_LINE = r"\n(?=[ \t\x0B\f\r]*[^ \t\x0B\f\r\n])"


def lines_of(text: Column) -> Column:
    """Lines with the blank ones behind them; a plain split where there are none."""
    return F.when(F.rlike(text, F.lit(r"\n(?:[ \t\x0B\f\r\n]|\z)")), F.split(text, NEXT_LINE)).otherwise(F.split(text, "\n"))


def once(value: Column, of) -> Column:
    """of(value), with value computed once: it is bound as a lambda's argument."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def units(lines: Column, min_words: int, spacing: int) -> Column:
    """array<struct<start, n, hash>>: chunks of several lines, seams, and long lines."""
    span = lambda start, n: F.struct(start.cast("int").alias("start"), n.cast("int").alias("n"))
    words = F.transform(lines, lambda x: F.regexp_count(x, F.lit(WORDS)))

    def spans(hashes: Column, words: Column) -> Column:
        last = F.size(hashes) - 2
        long_lines = F.filter(F.sequence(F.lit(0), last + 1), lambda i: F.get(words, i) >= min_words)
        long_lines = F.transform(long_lines, lambda i: span(i, F.lit(1)))

        def chunks(rolled: Column) -> Column:
            runs = lambda i: F.sequence(F.greatest(i - spacing + 1, F.lit(0)), F.least(i, F.greatest(last + 1 - spacing, F.lit(0))))
            least = lambda i: F.exists(runs(i), lambda s: F.array_min(F.slice(rolled, s + 1, spacing)) == F.get(rolled, i))
            full = lambda i: F.get(words, i) + F.get(words, i + 1) >= min_words
            at = F.filter(F.sequence(F.lit(0), last), lambda i: full(i) | least(i))
            return once(F.concat(F.array(F.lit(-1)), at, F.array(last + 1)), between)

        def between(edges: Column) -> Column:
            pairs = F.arrays_zip(F.slice(edges, 1, F.size(edges) - 1).alias("a"), F.slice(edges, 2, F.size(edges) - 1).alias("b"))
            whole = F.filter(F.transform(pairs, lambda e: span(e["a"] + 1, e["b"] - e["a"])), lambda s: s["n"] > 1)
            seams = F.transform(F.slice(edges, 2, F.size(edges) - 2), lambda i: span(i, F.lit(2)))
            return F.concat(seams, whole)

        rolled = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(hashes, i, 2)))
        return F.concat(F.when(last >= 0, once(rolled, chunks)).otherwise(F.array().cast("array<struct<start:int,n:int>>")), long_lines)

    def hashed(hashes: Column) -> Column:
        every = once(words, lambda w: spans(hashes, w))
        return F.transform(every, lambda s: F.struct(s["start"].alias("start"), s["n"].alias("n"), F.xxhash64(F.slice(hashes, s["start"] + 1, s["n"])).alias("hash")))

    return once(F.transform(lines, lambda x: F.xxhash64(x)), hashed)


def texts(found: Column, lines: Column, spacing: int) -> Column:
    """array<struct<start, n, step, hash, chunk>>: each unit's bytes (step 0), and the lines outwards from it where it has two lines.

    A line outwards has its distance as step, below 0 before the seam. The lines between are told by 64 bits as hash and 64 of another kind before the line's bytes.
    """
    text = lambda start, n: F.array_join(F.slice(lines, start + 1, n), "\n")
    row = lambda start, n, step, hash_, chunk: F.struct(start.cast("int").alias("start"), n.cast("int").alias("n"), step.cast("int").alias("step"), hash_.alias("hash"), chunk.alias("chunk"))
    own = F.transform(found, lambda u: row(u["start"], u["n"], F.lit(0), u["hash"], text(u["start"], u["n"]).cast("binary")))
    if spacing == 1:
        return own

    def outward(start: Column, step: Column) -> Column:
        behind = F.when(step > 0, text(start, step + 1)).otherwise(text(start + step + 1, 1 - step))
        at = start + step + F.when(step > 0, 1).otherwise(0)
        return once(behind, lambda x: row(at, F.lit(1), step, F.xxhash64(x), F.concat(F.unhex(F.substring(F.md5(x), 1, 16)), F.get(lines, at).cast("binary"))))

    steps = F.array(*(F.lit(k) for k in range(1 - spacing, spacing) if k))
    there = lambda u: F.filter(steps, lambda k: (u["start"] + k >= 0) & (u["start"] + k + 1 < F.size(lines)))
    more = F.flatten(F.transform(F.filter(found, lambda u: u["n"] == 2), lambda u: F.transform(there(u), lambda k: outward(u["start"], k))))
    return F.concat(own, more)


def line_dedup(docs: DataFrame, min_words: int = 50, spacing: int = 2, drop_emptied: bool = False, id_col: str = "doc_id", text_col: str = "text", counts: bool = False, hot: int = 1000) -> DataFrame:
    """docs with repeated passages removed; drop_emptied: without texts of which nothing is left.

    counts: two more columns, n_lines and n_removed.
    """
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_d"), F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_t"))
    # The lines are a column: within a lambda, an expression would be split anew for every line.
    split = keyed.where("_t <> ''").select("_id", "_h", lines_of(F.col("_t")).alias("_lines"))
    spans = cut(split.select("_id", "_h", F.explode(units(F.col("_lines"), min_words, spacing)).alias("u")).select("_id", "_h", "u.start", "u.n", "u.hash"), "lines")
    repeated = spans.groupBy("hash").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("hash")
    mine = spans.join(repeated, "hash", "left_semi").groupBy("_id", "_h").agg(F.collect_set(F.struct("start", "n", "hash")).alias("_units"))

    # Byte comparison: equal hashes are grouped by the chunk's text.
    # Texts travel once; documents without a repeated chunk pass from this table to the result.
    met = keyed.join(mine.select(F.col("_id").alias("_mid"), F.col("_h").alias("_mh"), "_units").hint("merge"), F.col("_id").eqNullSafe(F.col("_mid")) & (F.col("_h") == F.col("_mh")), "left").select("_d", "_id", "_h", "_units")
    met = cut(met, "texts").withColumn("_t", F.col("_d")[text_col].cast("string"))
    # Chunks are cut out before they become rows, so that no row carries its document's lines.
    held = met.where("_units is not null").select("_id", "_h", "_units", lines_of(F.col("_t")).alias("_lines"))
    chunks = cut(held.select("_id", "_h", F.inline(texts(F.col("_units"), F.col("_lines"), spacing))), "chunks")
    place, same = F.struct("_id", "_h", "start"), ["n", "step", "chunk"]
    firsts = cut(chunks.groupBy("hash", *same).agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"), "firsts")
    often = firsts.where(F.octet_length("chunk") <= 4096).orderBy(F.desc("times"), "hash").limit(hot).select("hash", *same, F.col("first").alias("_often"))
    # What has met its first occurrence goes on without its bytes.
    later = chunks.join(F.broadcast(often), ["hash", *same], "left").withColumn("chunk", F.when(F.col("_often").isNull(), F.col("chunk")))
    later = later.withColumn("_key", F.when(F.col("_often").isNull(), F.col("hash")).otherwise(F.monotonically_increasing_id()))
    later = later.join(firsts.select(F.col("hash").alias("_key"), *same, "first"), ["_key", *same], "left").where(place > F.coalesce("_often", "first"))
    lines = later.select("_id", "_h", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at"))
    gone = lines.groupBy(F.col("_id").alias("_gid"), F.col("_h").alias("_gh")).agg(F.collect_set("at").alias("_gone"))

    with_units, without = met.where("_units is not null"), met.where("_units is null")
    out = with_units.join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_h") == F.col("_gh")), "left").select("_d", "_t", "_gone")
    out = out.unionByName(without.select("_d", "_t", F.lit(None).cast("array<int>").alias("_gone")))
    out = out.withColumn("_lines", lines_of(F.col("_t")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    left = F.transform(kept, lambda i: F.get("_lines", i))
    changed = F.col("_gone").isNotNull()
    out = out.withColumn("_new", F.when(changed, F.array_join(left, "\n")).otherwise(F.col("_t")))
    if drop_emptied:
        out = out.where(~changed | F.rlike("_new", F.lit(WORDS)))
    cols = [F.when(changed, F.length("_new").cast(docs.schema[c].dataType)).otherwise(F.col("_d")[c]).alias(c) if c == "n_chars" else F.col("_new").alias(c) if c == text_col else F.col("_d")[c].alias(c) for c in docs.columns]
    if counts:
        cols += [F.when(F.col("_t").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines"), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed")]
    return out.select(*cols)
