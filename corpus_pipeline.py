"""The corpus pipeline: toxicity, line dedup, near duplicates, decontamination, packing.

Each stage works on all that its predecessor kept, is written as Parquet in the shared folder and read
again by the next. All but the last return the columns of `documents`. A stage starts by dropping the
scratch tables that the pipeline's earlier stages made, unless its input still reads them; tables of
other callers stay, also those that they made with the same operators.

Cases: null and empty texts pass all stages and are packed as the end id alone. Rows with a null id have
no label, link with nothing and pass. Of rows that repeat both id and text each stays or goes with the
others, through all stages; rows that repeat an id only are documents of their own. Of equal
texts the first by id keeps its lines; the others, emptied, go. An empty table gives empty results of
the same columns. Other columns pass unread, whatever their names; a row keeps its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quantloom.llm.common import cut, owned, table
from quantloom.llm.decontaminate import decontaminate
from quantloom.llm.line_dedup import line_dedup
from quantloom.llm.ngram_join import drop_near_duplicates
from quantloom.llm.packing import pack
from quantloom.llm.toxicity import drop_toxic

#: Models and 64-bit joins: no SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with owned("pipeline", spark, docs):
        return drop_toxic(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with owned("pipeline", spark, docs):
        return line_dedup(docs, drop_emptied=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with owned("pipeline", spark, docs):
        return drop_near_duplicates(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with owned("pipeline", spark, docs):
        return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with owned("pipeline", spark, docs):
        return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("decontamination", benchmark),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with owned(f"pipeline {uuid.uuid4().hex}"):
        for name, stage in STAGES:
            docs = cut(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
