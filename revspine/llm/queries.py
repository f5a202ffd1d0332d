"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, html_extract, language_id, packing, prefix_trie, repeats, secrets_scan, sharding, simhash_dedup, token_alignment, toxicity, word_lexicon
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup.membership(table(spark, sf_dir, "documents"))


def op2_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


def op3_toxicity(spark, sf_dir):
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_secrets(spark, sf_dir):
    return secrets_scan.scan_documents(table(spark, sf_dir, "documents"))


def op5_language_id(spark, sf_dir):
    return language_id.classify(table(spark, sf_dir, "documents"))


def op6_decontamination(spark, sf_dir):
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_sharding(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


def op8_repeats(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


def op9_html_extraction(spark, sf_dir):
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op10_simhash_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark, sf_dir):
    return token_alignment.digest(table(spark, sf_dir, "documents"), TOKENIZER, PIECE_TOKENIZER)


def op12_word_lexicon(spark, sf_dir):
    return word_lexicon.digest(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.trie(prefix_trie.paths(table(spark, sf_dir, "conversations"), family=5, splice=9))


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    own = (op1_exact_dedup, op2_packing, op3_toxicity, op4_secrets, op5_language_id, op6_decontamination, op7_sharding, op8_repeats,
           op9_html_extraction, op10_simhash_dedup, op11_token_alignment, op12_word_lexicon, op13_prefix_trie, pipeline)
    return {q.__name__: q for q in own}
