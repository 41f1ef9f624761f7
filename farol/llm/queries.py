"""The training-data operators as named queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farol.llm import (
    byte_bpe, collocations, conversation_trie, decontaminate, exact_dedup, gru_lm, jaccard_join, language_id, license_scan, packing, suffix_dedup, token_counts, token_store,
)
from farol.llm.common import read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score_documents(read(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(license_scan.with_paths(read(spark, sf_dir, "documents")))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "source", packing.word_length().alias("words"),
        F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("cluster"))
    return packing.pack(docs, "words")


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.encode_corpus(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = byte_bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(vocabulary.decode(vocabulary.encode(read(spark, sf_dir, "documents"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(read(spark, sf_dir, "conversations"))


QUERIES = [
    op1_decontaminate, op2_suffix_dedup, op3_gru_lm, op4_token_counts, op5_license_scan, op6_jaccard_join, op7_language_id, op8_best_fit_packing, op9_token_store,
    op10_exact_dedup, op11_byte_bpe, op12_collocations, op13_conversation_trie,
]
