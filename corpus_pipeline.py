"""Corpus pipeline: quality, near-duplicates, repeated passages, secrets, packing.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame that is written as Parquet and read again for the next
one. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleethealth.llm import minhash, packing, quality, secret_scan, substring
from fleethealth.llm.store import staged

CAPACITY = 2048
WORD_TOKENIZER = "word_bpe_49k.json"


def counted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, follows the text (code points); a null text
    keeps what it had."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.deduplicated(docs).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without words that a smaller document has in a common run of 13."""
    return counted(substring.without_repeats(docs))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked."""
    return counted(secret_scan.redacted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of at most 2048."""
    pieces = packing.cut_pieces(docs, public_tokenizers.path(WORD_TOKENIZER), end_id=0, capacity=CAPACITY)
    return packing.pack(pieces, CAPACITY)


STAGES = [
    ("quality classifier", quality_filter),
    ("MinHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("secret scans", secrets),
    ("best-fit packing", packed),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
