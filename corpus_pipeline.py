"""Corpus pipeline: documents -> toxic documents out -> exact copies out -> near copies out -> repeated passages cut ->
packed sequences.

Each stage takes what its predecessor kept (all of it) and returns a table with the columns of ``documents``; the last
returns the packed pieces. ``run`` writes each stage's result to the shared checkpoint folder and reads it again.

Defined results: an empty or null text is kept unless another row has the same (empty) text; a document that loses all
its bytes stays as an empty text; rows that repeat an id go or stay together in the near-copy stage; columns beside those
of ``documents`` pass through the first four stages unchanged, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from foldframe.llm.common import ready, written
from foldframe.llm.exact_dedup import exact_dedup, lower_az
from foldframe.llm.packing import pack
from foldframe.llm.simhash import simhash_dedup
from foldframe.llm.suffix_dedup import remove_repeats
from foldframe.llm.toxicity import fit, labelled_words, score

#: Not expressible in SQL: the classifier, near copies by fingerprints, tokenisation.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject, fitted on the labelled ones among them."""
    model = fit(labelled_words(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    scored = score(docs, model, keep=docs.columns)
    return scored.where("not toxic").select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(docs.columns)])


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``docs`` has, whatever their case."""
    longest = max((len(c) for c in docs.columns), default=0)
    return [name + "_" * longest for name in names]


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text but for the case of A-Z, the one with the largest id."""
    id_, sha, norm = _free(docs, "id", "sha", "norm")
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(sha)).distinct()
    named = docs.withColumn(norm, F.sha2(lower_az(F.coalesce("text", F.lit(""))).cast("binary"), 256))
    stay = named.join(kept, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(norm) == F.col(sha)), "left_semi")
    return stay.dropDuplicates(["doc_id", norm]).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest id."""
    id_, = _free(docs, "id")
    kept = simhash_dedup(docs).where("kept").select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col(id_)), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; a character cut in half goes.

    The text travels once, as the bytes that are cut; whether it was null is kept beside the other columns."""
    others = [c for c in docs.columns if c != "text"]
    null, = _free(docs, "null")
    cut = remove_repeats(docs.withColumn(null, F.col("text").isNull()), keep=(*others, null), with_text=True, whole_characters=True)
    column = {c: F.col(f"k{i}") for i, c in enumerate(others)}
    text = F.col("kept").cast("string")
    column["text"] = F.when(~F.col(f"k{len(others)}"), text)
    if "n_chars" in column:
        column["n_chars"] = F.when(F.col("n_removed") > 0, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(column["n_chars"])
    return cut.select(*[column[c].alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their token ids and their place in sequences of at most 4096 tokens."""
    # the workers of earlier stages are still there: a small memory of words in each, and none after a task
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True, memory_words=120_000, forget=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ready(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
