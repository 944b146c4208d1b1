"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept and returns those it
keeps (the last one: the packed pieces); each result is written as Parquet and
read again.

1. language ID: documents without a letter, or of no language that the
   network tells, go;
2. exact dedup: of texts equal up to white space one document stays;
3. near dedup: one document of each group of near copies stays;
4. suffix dedup: 400-byte strings that repeat are taken out of the texts;
5. packing: tokenized documents in sequences of at most 4096 tokens.

Every stage takes and keeps any further columns, whatever their names (the last
returns pieces).  A null or empty text goes in stage 1, which finds no letter in
it; repeated rows are copies like any others and meet in stages 2 and 3; ties are
decided by the smallest id, a null id last; very long texts are read whole; an
empty table gives an empty result.

Stages 1, 3 and 4 learn or look for links over all of their own input.  There
is no SQL for the whole: a trained network and packing are not expressible.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from relq.llm import exact_dedup, langid, minhash, packing, suffix_dedup
from relq.llm.shipping import ship
from relq.llm.staging import staged

ORACLE_SQL = None
NEAR = 80  # of 100: similarity of the 5-word shingles from which documents are near copies


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return langid.accepted(docs, langid.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return minhash.one_of_each(docs, share=NEAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack_documents(docs, Path(public_tokenizers.path("word_bpe_49k.json")).read_text())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("suffix_dedup", repeated_passages),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
