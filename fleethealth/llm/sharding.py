"""Reproducible shuffle into shards by a Feistel permutation of row numbers.

Rows get global numbers in (key, text hash) order, so the result does not depend
on files or partitions. A keyed Feistel network over the next even power of two
permutes the numbers; places outside the table are walked on (cycle walking)
until they fall inside. Shard and slot are the remainder and quotient of the
place, and both directions can be computed without any table: ``place_of`` gives
the place of a row, ``row_at`` the row of a place.

Groups of equal texts are not kept together; the law is ``rows``: shard sizes
differ by at most one row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from fleethealth.llm.store import numbered
from fleethealth.llm.text import U64, mix

ROUNDS = 6


def _keys(seed: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + mix(np.array([seed], dtype=U64))[0])


def _network(x: np.ndarray, half: int, keys: np.ndarray, forward: bool) -> np.ndarray:
    mask = U64((1 << half) - 1)
    left, right = x >> U64(half), x & mask
    if forward:
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
    else:
        for k in keys[::-1]:
            left, right = right ^ (mix(left ^ k) & mask), left
    return (left << U64(half)) | right


def _walk(x: np.ndarray, n: int, seed: int, forward: bool) -> np.ndarray:
    keys, half = _keys(seed), max(1, ((n - 1).bit_length() + 1) // 2)
    out = np.asarray(x, dtype=U64)
    out = _network(out, half, keys, forward)
    # The network is a bijection, so a walk from inside comes back inside.
    while (away := np.flatnonzero(out >= U64(n))).size:
        out[away] = _network(out[away], half, keys, forward)
    return out


def place_of(rows: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Places of row numbers below ``n``."""
    return _walk(rows, n, seed, True)


def row_at(places: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Row numbers of places below ``n``; the inverse of ``place_of``."""
    return _walk(places, n, seed, False)


def shard(df: DataFrame, shards: int, key: str = "doc_id", tie: str = "text_crc32", seed: int = 0) -> DataFrame:
    """``df`` with ``place``, ``shard`` (0 to shards-1) and gapless ``slot``.

    Null keys come first in the numbering; equal rows are interchangeable. An
    empty table stays empty. Columns of these names in ``df`` are replaced.
    Carry only the columns needed: all of them go through one range shuffle.
    """
    base = df.drop("place", "shard", "slot", "__row")
    rows = numbered(base, [F.col(key).asc_nulls_first(), F.col(tie).asc_nulls_first()], "shard-rows", "__row")
    n = rows.count()

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(place_of(row.to_numpy(), n, seed).astype(np.int64))

    placed = rows.withColumn("place", place("__row")).drop("__row")
    return placed.select(
        "*", (F.col("place") % shards).cast("int").alias("shard"),
        F.floor(F.col("place") / F.lit(shards)).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int, **kw) -> None:
    """Whole rows as one folder per shard, files sorted by slot. A shard is
    spread over tasks by slot ranges, so large shards do not meet in one task."""
    placed = shard(df, shards, **kw)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def digest(documents: DataFrame, shards: int = 40) -> DataFrame:
    """Size, checksum and place of each document; null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    slim = documents.select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard(slim, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "place")
