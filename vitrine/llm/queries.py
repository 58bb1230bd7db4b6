"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm import cross_tokenizer, embedding_dedup, language_id, line_dedup, lm_score, merkle, mixing
from vitrine.llm import ngram_join, permutation_index, sentencepiece_sampling, suffix_dedup, url_reputation, wavelet
from vitrine.llm.common import TOKENIZERS, table
from vitrine.llm.oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_counts(table(spark, sf_dir, "documents"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_sampling.sample_segmentations(
        table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model")


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokenizer.token_alignment(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json",
                                           f"{TOKENIZERS}/piece_bpe_32k.model")


def op12_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")).drop("lower")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_mixing, op2_line_dedup, op3_embedding_dedup, op4_sentencepiece, op5_nearest, op6_token_files, op7_ngram_join,
    op8_lm_scoring, op9_language_id, op10_suffix_dedup, op11_token_alignment, op12_url_reputation, op13_merkle)}

__all__ = ["ORACLES", "QUERIES"]
