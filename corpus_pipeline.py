"""Corpus pipeline: documents to packed training sequences.

Five stages, each one operator applied to all that the stage before kept.  A
stage's result is written as Parquet in the shared folder and read again, so a
lost executor costs a re-read and no stage is computed twice; the stage before
is deleted then, and the last one when the program ends.

Defined results: documents without text or without a letter go in the first
stage; texts of any length are whole; of repeated rows one stays; rows with a
NULL id, and different texts under one id, are documents of their own; other
columns, also clashing ones, reach the last stage; an empty table gives no pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revspine.llm import decontaminate, exact_dedup, language_id, packing, simhash_dedup
from revspine.llm.common import forget, in_fold, shared_folder, stored, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LEAST_CONFIDENCE = 0.3  # of the best language; `und` has 0

#: No SQL states the first stage (a fitted classifier); the tests compare with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: those without a letter or without any
    confident language go; all columns stay."""
    model = language_id.fit(docs.where(~in_fold(F.col("doc_id"), 4, 2)))
    return language_id.confident(docs, model, LEAST_CONFIDENCE)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text (up to white space): that with the smallest id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per SimHash component (3-word shingles, 3 bits): that with the smallest id, of equal ids that with the smallest text hash."""
    return simhash_dedup.drop_near_duplicates(docs, width=3, tau=3)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found (5-word shingles, similarity 0.8)."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens, with their ids."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("language ID", language), ("exact dedup", exact), ("SimHash near-dedup", near), ("benchmark decontamination", clean), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        folder = shared_folder(spark)
        docs = stored(stage(spark, docs, sf_dir), folder)
        if before:
            forget(spark, before)
        before = folder
    return docs
