"""Digest cache of token counts: texts are looked up by digest, only distinct misses are encoded.

The key is the SHA-256 of the normalised content and a digest of the tokenizer file and library
version, so a new vocabulary or library never reads old counts. Normalisation must keep counts
exact, and sentencepiece's own normaliser is the identity for the model used here, so the default
only turns null into the empty text; another may be passed for tokenizers that fold more.

Misses are made distinct by a hash aggregation that combines within each map task first, so a text
that a third of all rows share is sent once per map task and encoded once. New counts are appended
to the cache (a Parquet table in a shared folder) before the join that reads them. In that join, the
most frequent digests, a bounded number, are broadcast, so no task gets a text's every row.

Cases: null and empty text count 0 bytes and 0 tokens. Long texts are encoded whole. Repeated rows
stay repeated. Other columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, in_batches, local_file, record_batch, scratch, ship, slices, worker_store

CACHE = "content_digest binary, n_tokens long"


def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """The library's plain encoding: no begin, end or added special tokens, no truncation, no padding."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=local_file(path))
        return lambda texts: model.encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(local_file(path))
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def worker_encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    held = worker_store("subwords", "encoders")
    return held.get(path) or held.setdefault(path, encoder(path))


def tokenizer_digest(path: str) -> str:
    import sentencepiece
    import tokenizers

    library = sentencepiece if path.endswith(".model") else tokenizers
    return hashlib.sha256(Path(path).read_bytes() + f"{library.__name__} {library.__version__}".encode()).hexdigest()


class Count:
    def __init__(self, path: str):
        self.path = path

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_encoder(self.path)
        for b in slices(batches, max_bytes=1 << 20):
            yield record_batch(["content_digest", "n_tokens"], [pa.binary(), pa.int64()], [b.column(0).cast(pa.binary()), [len(x) for x in encode(b.column(1).to_pylist())]])


def read_cache(spark: SparkSession, folder: str) -> DataFrame | None:
    try:
        return spark.read.schema(CACHE).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def digested(docs: DataFrame, id_col: str, text_col: str, normalise: Callable[[Column], Column]) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"), F.unhex(F.sha2(normalise(text), 256)).alias("content_digest"), normalise(text).alias("_text"))


def plain(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def fill(docs: DataFrame, tokenizer: str, cache: str, text_col: str = "text", normalise: Callable[[Column], Column] = plain) -> str:
    """Appends the counts of texts that the cache hasn't; returns the folder of this tokenizer's counts."""
    spark = docs.sparkSession
    ship(spark, tokenizer)
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    # Copies combine within map tasks, and before the join to what is stored.
    asked = digested(docs, text_col, text_col, normalise).groupBy("content_digest").agg(F.first("_text").alias("_text"))
    stored = read_cache(spark, folder)
    misses = asked if stored is None else asked.join(stored, "content_digest", "left_anti")
    in_batches(misses, Count(tokenizer), CACHE).write.mode("append").option("compression", "zstd").parquet(folder)
    return folder


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", normalise: Callable[[Column], Column] = plain, hot: int = 1000) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit for each row. cache: a folder to read and append to; its own one if None."""
    spark = docs.sparkSession
    folder = fill(docs, tokenizer, cache or scratch(spark, "token_counts"), text_col, normalise)
    rows = digested(docs, id_col, text_col, normalise).drop("_text")
    asked = cut(rows.groupBy("content_digest").agg(F.count(F.lit(1)).alias("times")), "asked")
    # Of the cache only what is asked for goes on. Two writers may have appended a digest; their counts are equal.
    known = asked.join(read_cache(spark, folder), "content_digest").groupBy("content_digest").agg(F.max("times").alias("times"), F.max("n_tokens").alias("n_tokens"))
    known = cut(known, "known")
    # The `hot` most frequent digests are broadcast; rows of the others meet their count by a shuffle.
    often = known.orderBy(F.desc("times"), "content_digest").limit(hot).select("content_digest", F.col("n_tokens").alias("_often"))
    rows = rows.join(F.broadcast(often), "content_digest", "left").withColumn("_key", F.when(F.col("_often").isNull(), F.col("content_digest")).otherwise(F.unhex(F.sha2(F.monotonically_increasing_id().cast("string"), 224))))
    n_tokens = F.coalesce("_often", "n_tokens")
    found = rows.join(known.select(F.col("content_digest").alias("_key"), "n_tokens"), "_key", "left")
    return found.select(id_col, "n_bytes", n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"))
