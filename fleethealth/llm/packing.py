"""Packing of token pieces into fixed-length sequences with certified counts.

Pieces are dealt over partitions and packed there best-fit decreasing. Dual
feasible functions give a lower bound on the number of sequences, both for each
partition and, from the histogram of lengths, for the whole. Partitions above
their bound, and sequences less than half full anywhere, put their pieces into
a pool; the pool is dealt anew and packed again, and the new packing is kept
only if it needs fewer sequences. This ends at the global bound, when a round
saves nothing, or after ``rounds`` rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleethealth.llm.store import small_batches, staged
from fleethealth.llm.tokens import tokenizer

PART_ITEMS = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(df: DataFrame, path: str, end_id: int, capacity: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of each text plus ``end_id``; only longer ones are cut. Null text is empty."""
    end = np.array([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                ids = words.encode(text) + end
                for i, a in enumerate(range(0, len(ids), step)):
                    part = ids[a:a + step]
                    rows.append((doc, i, a // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return small_batches(df).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item and the fill of each bin, best-fit decreasing.

    Open bins are kept by their free room; a bit mask of the rooms in use finds
    the tightest one that fits.
    """
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    used, mask = [], 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                mask ^= 1 << room
        else:
            b, room = len(used), capacity
            used.append(0)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        left = room - size
        if left:
            if not by_room[left]:
                mask |= 1 << left
            by_room[left].append(b)
    return bins, offsets, np.array(used, dtype=np.int64)


def lower_bound(histogram: np.ndarray) -> int:
    """Least number of bins for ``histogram[length]`` items, by dual feasible functions.

    Threshold functions drop items below t and round those above capacity - t
    up to a whole bin; rounding functions take floor((k+1)x)/k unless (k+1)x is
    whole. Each keeps any feasible bin at one, so the sum is a bound.
    """
    capacity = len(histogram) - 1
    x = np.arange(capacity + 1)
    best = 0
    for k in range(1, 33):
        scaled = (k + 1) * x
        # In units of 1 / (k * capacity), so that all sums stay whole.
        value = np.where(scaled % capacity == 0, k * x, scaled // capacity * capacity)
        best = max(best, -(-int((histogram * value).sum()) // (k * capacity)))
    weight, many = np.cumsum(histogram * x), np.cumsum(histogram)
    t = np.arange(0, capacity // 2 + 1)
    whole = many[-1] - many[capacity - t]
    middle = weight[capacity - t] - np.where(t > 0, weight[np.maximum(t - 1, 0)], 0)
    return int(max(best, (whole + -(-middle // capacity)).max()))


def _packed(items: DataFrame, capacity: int, part_items: int, number: int) -> DataFrame:
    """One round: deal ``(item, length)`` over partitions and pack each."""
    parts = max(1, -(-items.count() // part_items))
    schema = "item long, length long, sequence_id long, offset long, fill long, gap long"

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        size = group["length"].to_numpy()
        bins, offsets, used = best_fit(size, capacity)
        bound = lower_bound(np.bincount(size, minlength=capacity + 1))
        base = (number << 56) + (int(group["part"].iloc[0]) << 24)
        return pd.DataFrame({
            "item": group["item"], "length": size, "sequence_id": base + bins, "offset": offsets,
            "fill": used[bins], "gap": len(used) - bound})

    dealt = items.select("item", "length", F.pmod(F.xxhash64("item", F.lit(number)), F.lit(parts)).alias("part"))
    return dealt.groupBy("part").applyInPandas(pack, schema)


def pack(pieces: DataFrame, capacity: int = 2048, rounds: int = 3, part_items: int = PART_ITEMS) -> DataFrame:
    """``pieces`` (any columns, ``length`` of 1 to capacity) with ``sequence_id`` and ``offset``.

    Columns of these names are replaced. Equal rows are packed apart like any
    others; an empty table gives an empty result.
    """
    base = pieces.drop("sequence_id", "offset", "item")
    held = staged(base.withColumn("item", F.monotonically_increasing_id()), "pieces")
    # At most one row per length.
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in held.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    bound = lower_bound(counts)
    bins = lambda df: df.where(F.col("offset") == 0).count()
    placed = staged(_packed(held.select("item", "length"), capacity, part_items, 0), "packed")
    total = bins(placed)
    for number in range(1, rounds + 1):
        if total <= bound:
            break
        loose = ((F.col("gap") > 0) & (F.col("fill") < capacity)) | (F.col("fill") * 2 < capacity)
        pool = placed.where(loose)
        again = staged(_packed(pool.select("item", "length"), capacity, part_items, number), "repacked")
        saved = bins(pool) - bins(again)
        if saved <= 0:
            break
        placed, total = placed.where(~loose).unionByName(again), total - saved
    return held.join(placed.select("item", "sequence_id", "offset"), "item").drop("item")


def sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """The packed sequences themselves: one row of at most ``capacity`` ids each,
    from placed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    return placed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))
