"""Bloom filters of keys as plain columns: what cannot match leaves the scan before a shuffle.

A filter is one row with an array of 64-bit words. It is built by an aggregate
(bit by bit, merged on the map side) and read as a scalar subquery, so its size is
the number of bits asked for, whatever the number of keys: more keys only let more
rows pass. It decides nothing by itself; an exact join follows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fleethealth.functions import bt

PROBES = 4
BITS_PER_KEY = 10  # about 1.2 % of foreign keys pass
MIN_BITS, MAX_BITS = 1 << 12, 1 << 26  # 512 bytes to 8 MB


def bits_for(keys: int) -> int:
    """Bits for that many keys, a power of two within the limits."""
    return min(MAX_BITS, max(MIN_BITS, 1 << (keys * BITS_PER_KEY - 1).bit_length()))


def _places(keys: Sequence[Column], bits: int) -> list[Column]:
    """Bit numbers of a key. Equal keys, nulls included, have equal bits."""
    return [F.xxhash64(F.lit(i), *keys).bitwiseAND(F.lit(bits - 1)) for i in range(PROBES)]


def _word(place: Column) -> Column:
    return F.shiftright(place, 6).cast("int")


def _mask(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def key_filter(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """One row, ``words``: the filter of the keys of ``df``."""
    place = F.explode(F.array(*_places([bt(k) for k in keys], bits))).alias("place")
    hits = df.select(place).select(_word(F.col("place")).alias("word"), _mask(F.col("place")).alias("mask"))
    empty = df.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("mask"))
    words = hits.unionByName(empty).groupBy("word").agg(F.bit_or("mask").alias("mask"))
    return words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "mask"))), lambda w: w["mask"]).alias("words"))


def may_contain(words: Column, keys: Sequence[Column], bits: int) -> Column:
    """False only for keys that are not in the filter."""
    hit = [F.get(words, _word(p)).bitwiseAND(_mask(p)) != 0 for p in _places(keys, bits)]
    return reduce(lambda a, b: a & b, hit)
