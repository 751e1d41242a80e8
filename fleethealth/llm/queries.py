"""One query per operator over whole tables, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleethealth.llm import (
    hard_negatives, minhash, nbest, packing, quality, ranked, secret_scan, sharding, substring, token_counts, token_files,
    topk, winnow)
from fleethealth.session import scratch_dir, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {
    "op5_minhash": minhash.NEAR_DUPLICATES_SQL,
    "op6_block_max_top_k": topk.DIGEST_SQL,
    "op7_substring_fm_index": substring.DIGEST_SQL,
    "op11_nra_search": ranked.DIGEST_SQL,
    "op12_hard_negatives": hard_negatives.DIGEST_SQL,
}

WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(tune(spark), sf_dir)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(table(spark, sf_dir, "documents"), 40)


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(WORD_TOKENIZER), end_id=2)
    return token_files.digest(token_files.read(spark, folder))


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.digest(table(spark, sf_dir, "documents"))


@query
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=5, percent=75)


@query
def op6_block_max_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.digest(table(spark, sf_dir, "embeddings"))


@query
def op7_substring_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digest(table(spark, sf_dir, "documents"), window=13)


@query
def op8_nbest_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL), n=4)


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER), end_id=0, capacity=2048)
    return packing.pack(pieces, 2048)


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@query
def op11_nra_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
