"""The registered queries of this folder: one for each operator, and the pipeline."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import sql
from .byte_bpe import bpe_round_trip
from .exact_dedup import exact_dedup
from .hard_negatives import mine
from .language_model import lm_scores
from .packing import pack
from .sharding import shard_rows
from .simhash import simhash_dedup
from .sketches import document_fingerprints
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .toxicity import toxicity
from .url_filter import url_filter
from .whitening import whiten


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(_documents(spark, sf_dir)).drop("moved")


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(_documents(spark, sf_dir))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_counts, op2_suffix_dedup, op3_simhash_near_dedup, op4_best_fit_packing, op5_lm_scoring, op6_byte_bpe,
        op7_exact_dedup, op8_sharding, op9_document_fingerprints, op10_toxicity, op11_url_filter, op12_embedding_whitening,
        op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return {"op7_exact_dedup": sql.EXACT_DEDUP, "op13_hard_negatives": sql.HARD_NEGATIVES}
