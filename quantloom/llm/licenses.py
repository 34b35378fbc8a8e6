"""Licence scan by ordered signature rules, in DataFrame functions only.

Each rule is a hand-written regex behind a keyword: a text is matched only against the rules whose
keyword it contains. Detections are character intervals. One that lies inside another detection of
the same text is suppressed if the other's level (the rule's family, the generic reference to a licence
last) is the same or comes before: a longer interval wins within a level, and among equal intervals the
rule that stands first. So a weaker statement never hides a licence named in it. Suppression is a running maximum within buckets of fixed width of the text, each detection
being sent to the buckets it touches, so no text, however full of licences, is one group, and no
pairs of detections are formed.

Cases: null and empty text have no words, no places and no labels (empty strings, score 0). Long
texts are matched whole. Repeated rows (also of one id) are told apart by a row number given once
and written down. Only the id and text columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import collections
import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut
from .license_rules import level_ends, rules

#: The word class of the base measures.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Width in characters of the buckets for suppression; any width gives the same result.
BUCKET = 4096


def rule_table() -> Column:
    return F.array(*(F.struct(F.lit(p).alias("priority"), F.lit(label).alias("label"), F.lit(score).alias("score"), F.lit(kw).alias("keyword"), F.lit(rx).alias("regex")) for p, label, score, kw, rx in rules()))


def anchors(least: int = 7) -> list[str]:
    """A few parts of words of which every keyword contains one: a text without them contains no keyword."""
    left, found = sorted({keyword for *_, keyword, _ in rules()}), []
    while left:
        parts = collections.Counter(p for k in left for p in {w[i : i + least] for w in k.split() for i in range(len(w) - least + 1)} or {k})
        best = max(sorted(parts), key=parts.get)
        found.append(best)
        left = [k for k in left if best not in k]
    return found


def detections(text: Column) -> Column:
    """array<struct<priority, label, score, parts: array<struct<gap, len>>>>, one entry a rule that matches.

    parts: the matches in order, gap being the characters since the match before.
    """

    def of_rule(r: Column) -> Column:
        lengths = F.transform(F.regexp_extract_all(text, r["regex"], F.lit(0)), lambda x: F.length(x))
        gaps = F.transform(F.split(text, r["regex"], -1), lambda x: F.length(x))
        parts = F.arrays_zip(F.slice(gaps, 1, F.size(lengths)).alias("gap"), lengths.alias("len"))
        return F.struct(r["priority"].alias("priority"), r["label"].alias("label"), r["score"].alias("score"), parts.alias("parts"))

    gated = F.filter(rule_table(), lambda r: F.contains(text, r["keyword"]))
    return F.filter(F.transform(gated, of_rule), lambda x: F.size(x["parts"]) > 0)


def places(words: Column, phrase: list[str]) -> Column:
    """Word positions at which the phrase's words stand one after another."""
    at = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"] == phrase[0])
    whole = F.array(*(F.lit(p) for p in phrase))
    at = F.filter(at, lambda x: F.slice(words, x["i"] + 1, len(phrase)) == whole)
    return F.transform(at, lambda x: x["i"].cast("long"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections kept."""
    low = docs.select(F.col(id_col).alias("_id"), F.coalesce(ascii_lower(F.col(text_col).cast("string")), F.lit("")).alias("_low"))
    gate = functools.reduce(Column.__or__, (F.contains("_low", F.lit(x)) for x in anchors()))
    words = F.when(F.contains("_low", F.lit("license")), F.regexp_extract_all("_low", F.lit(WORD), F.lit(0)))
    first = low.select(
        F.monotonically_increasing_id().alias("_row"),
        "_id",
        F.regexp_count("_low", F.lit(WORD)).cast("long").alias("n_words"),
        words.alias("_words"),
        F.when(gate, detections(F.col("_low"))).alias("_found"),
    )
    found = first.select("_row", "_id", "n_words", "_found", *(F.coalesce(places(F.col("_words"), p.split()), F.array().cast("array<bigint>")).alias(f"_{label}") for p, label in PHRASES.items()))
    rows = cut(found, "licenses")

    each = rows.where(F.size("_found") > 0).select("_row", F.explode("_found").alias("d")).select("_row", "d.priority", "d.label", "d.score", F.posexplode("d.parts").alias("_k", "_part"))
    so_far = Window.partitionBy("_row", "priority").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("stop", F.sum(F.col("_part.gap") + F.col("_part.len")).over(so_far)).withColumn("start", F.col("stop") - F.col("_part.len")).drop("_part", "_k")
    sent = each.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / BUCKET), F.floor((F.col("stop") - 1) / BUCKET))))
    order = Window.partitionBy("_row", "_bucket").orderBy("start", F.desc("stop"), "priority").rowsBetween(Window.unboundedPreceding, -1)
    # In this order whatever contains a detection stands before it; it is judged in the bucket of its start.
    up_to = [(F.col("priority") < end, F.max(F.when(F.col("priority") < end, F.col("stop"))).over(order)) for end in level_ends()]
    covered = functools.reduce(lambda c, x: c.when(*x), up_to[1:], F.when(*up_to[0]))
    kept = sent.withColumn("_covered", covered).where((F.col("_bucket") == F.floor(F.col("start") / BUCKET)) & F.coalesce(F.col("stop") > F.col("_covered"), F.lit(True)))
    by_row = kept.groupBy("_row").agg(F.collect_set("label").alias("_more"), F.max("score").alias("_score"))

    all_places = F.concat(*(f"_{x}" for x in PHRASES.values()))
    base = F.array_compact(F.array(*(F.when(F.size(f"_{x}") > 0, F.lit(x)) for x in PHRASES.values())))
    out = rows.select("_row", "_id", "n_words", F.size(all_places).cast("long").alias("n_base"), F.array_min(all_places).alias("first_word"), F.array_max(all_places).alias("last_word"), F.array_sort(base).alias("_base"))
    none = F.array().cast("array<string>")
    return out.join(by_row, "_row", "left").select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_base", F.coalesce("_more", none))), ",").alias("labels"),
        F.greatest(F.coalesce("_score", F.lit(0.0)), F.when(F.size("_base") > 0, F.lit(0.7)).otherwise(F.lit(0.0))).alias("score"),
    )
