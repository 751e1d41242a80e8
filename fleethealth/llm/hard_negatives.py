"""Hard negatives by a secondary-sort shuffle.

An anchor's positives are the best rows of its label; negatives for a positive
are the best rows of other labels that score at most as much as the positive and
at least a given share of it.

Pairs are packed into keys (anchor, descending score, positive before negative,
id) and dealt by anchor with ``repartitionAndSortWithinPartitions``. A streaming
iterator then reads each anchor from its best pair downwards: a positive opens a
window, a negative goes to every open window, and a window ends when it is full or
the scores fall below its share. Nothing of an anchor is held but its windows.

Pairs are cut before they are packed, without loss. Rows are dealt into segments
by hash and anchors visit all segments in batches. First each segment gives its
best rows of the anchor's label, which are merged to the anchor's positives. With
their scores known, each segment then gives only the first negatives below each
of them: whatever the segment holds more could not enter a window.

Scores are whole numbers. They are exact for all finite components: products run
in doubles where these are exact, else in Python integers; a score beyond 64 bits
is an error. Vectors of different lengths do not meet. Ids are taken as unique: rows
that repeat an id are candidates of their own, never of an anchor of that id, and
of a repeated anchor the row with the smallest (label, vector) asks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleethealth.llm.store import staged, whole_groups

SEGMENT, LEAST_SEGMENT, BATCH, TOGETHER = 16_384, 1_024, 4_096, 128
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
PAIR = "anchor long, score long, id long"

_KEY = struct.Struct(">QQBQ")
_MIDDLE, _ALL = 1 << 63, (1 << 64) - 1
POSITIVE, NEGATIVE = 0, 1


def pack(anchor: int, score: int, kind: int, other: int) -> bytes:
    """A key whose byte order is (anchor, descending score, kind, id)."""
    return _KEY.pack(anchor + _MIDDLE, _ALL - (score + _MIDDLE), kind, other + _MIDDLE)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, other = _KEY.unpack(key)
    return anchor - _MIDDLE, _ALL - score - _MIDDLE, kind, other - _MIDDLE


def anchor_hash(key: bytes) -> int:
    """Partition of a key: its anchor alone decides."""
    return zlib.crc32(key[:8])


def least(score: int, percent: int) -> int:
    """Smallest whole s with percent * score <= 100 * s."""
    return -(-percent * score // 100)


def windows(keys: Iterable[bytes], negatives: int, percent: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of ``RESULT`` from sorted keys, one pass, holding only open windows."""
    anchor, opened = None, []
    for key in keys:
        own, score, kind, other = unpack(key)
        if own != anchor:
            anchor, opened = own, []
        if kind == POSITIVE:
            opened.append([other, score, least(score, percent), 0])
            continue
        opened = [w for w in opened if w[3] < negatives and score >= w[2]]
        for w in opened:
            # A negative may equal its positive; of a positive below 0 the share lies above it.
            w[3] += 1
            yield anchor, w[0], w[3], other, w[1], score


def whole_vectors(df: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """floor(scale * x) per component as ``terms``, in doubles, which hold it
    exactly; rows whose vector is null or has null or non-finite components are
    left out."""
    x = F.col(vector)
    finite = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    scaled = lambda v: v.cast("double") * scale
    # floor() goes through 64-bit integers; from 2^53 on a double is whole anyway.
    floored = lambda v: F.when(F.abs(scaled(v)) < F.lit(2.0 ** 53), F.floor(scaled(v)).cast("double")).otherwise(scaled(v))
    return df.where(F.coalesce(finite, F.lit(False))).withColumn("terms", F.transform(x, floored))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows as 64-bit integers."""
    size = np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * max(1, left.shape[1])
    if size < 2.0 ** 53:
        return (left @ right.T).astype(np.int64)
    if not np.isfinite(left).all() or not np.isfinite(right).all():
        raise ValueError("component beyond doubles")
    whole = np.frompyfunc(int, 1, 1)
    exact = np.dot(whole(left), whole(right.T))
    if exact.size and max(abs(int(exact.max())), abs(int(exact.min()))) >= _MIDDLE:
        raise ValueError("score beyond 64-bit integers")
    return exact.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties to smaller ids, best first."""
    place = np.arange(len(scores))
    if len(scores) > n:
        place = np.flatnonzero(scores >= np.partition(scores, -n)[-n])
    return place[np.lexsort((ids[place], -scores[place]))][:n]


class Segment:
    """Rows of one segment and width, grouped by label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, terms: np.ndarray) -> None:
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.terms = ids[order], labels[order], terms[order]

    def own(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))

    def positives(self, ids: np.ndarray, labels: np.ndarray, terms: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for label in np.unique(labels).tolist():
            asked, rows = np.flatnonzero(labels == label), self.own(label)
            for q, scores in zip(asked, products(terms[asked], self.terms[rows])):
                other = self.ids[rows] != ids[q]
                at = best(scores[other], self.ids[rows][other], n)
                yield ids[q], scores[other][at], self.ids[rows][other][at]

    def negatives(self, ids: np.ndarray, labels: np.ndarray, terms: np.ndarray, limits: list[list[int]], n: int,
                  percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Of each anchor the first ``n`` rows of other labels below each limit."""
        for q, scores in enumerate(products(terms, self.terms)):
            high = sorted({p for p in limits[q]}, reverse=True)
            low = [least(p, percent) for p in high]
            able = (scores <= high[0]) & (scores >= min(low)) & (self.ids != ids[q])
            able[self.own(labels[q])] = False
            able = np.flatnonzero(able)
            able = able[np.lexsort((self.ids[able], -scores[able]))]
            falling = -scores[able]
            keep = np.zeros(len(able), bool)
            for p, least_score in zip(high, low):
                a, b = np.searchsorted(falling, -p, "left"), np.searchsorted(falling, -least_score, "right")
                keep[a:min(b, a + n)] = True
            yield ids[q], scores[able[keep]], self.ids[able[keep]]


def _visits(rows: DataFrame, asked: DataFrame, segments: int, batches: int) -> DataFrame:
    """Rows and anchors dealt by (width, segment), the rows first."""
    place = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(segments))
    left = rows.select("width", place.alias("segment"), F.lit(-1).alias("batch"), "id", "label", "terms",
                       F.array().cast("array<long>").alias("limits"))
    # The stated anchor set against all rows, in blocks.
    right = asked.select(
        "width", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long"))).alias("segment"),
        F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"), "id", "label", "terms", "limits")
    return left.unionByName(right).repartition(segments, "width", "segment").sortWithinPartitions("width", "segment", "batch")


def _in_segments(visits: DataFrame, find) -> DataFrame:
    """``find(segment, ids, labels, terms, limits)`` for each batch of anchors."""
    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, segment = None, None
        for t in whole_groups(arrow, ["width", "segment", "batch"]):
            keys = np.stack([t[c].to_numpy() for c in ("width", "segment", "batch")], axis=1)
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                part = t.slice(a, b - a).combine_chunks()
                ids, labels = part["id"].to_numpy(), part["label"].to_numpy()
                flat = part["terms"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                terms = flat.reshape(len(ids), int(keys[a][0]))
                if keys[a][2] == -1:
                    held, segment = tuple(keys[a][:2]), Segment(ids, labels, terms)
                    continue
                if held != tuple(keys[a][:2]):
                    continue  # no row of this width here
                limits = part["limits"].to_pylist()
                for i in range(0, len(ids), TOGETHER):
                    j = slice(i, i + TOGETHER)
                    found = list(find(segment, ids[j], labels[j], terms[j], limits[j]))
                    many = [len(x[1]) for x in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(np.array([x[0] for x in found], np.int64), many)),
                         pa.array(np.concatenate([x[1] for x in found]).astype(np.int64)),
                         pa.array(np.concatenate([x[2] for x in found]).astype(np.int64))], names=["anchor", "score", "id"])

    return visits.mapInArrow(run, PAIR)


def mined(rows: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 5, percent: int = 80,
          segment: int = SEGMENT) -> DataFrame:
    """Rows of ``RESULT``: for each anchor and each of its first ``positives`` rows
    of the same label, the first ``negatives`` rows of other labels whose score is
    at most the positive's and at least ``percent`` of it.

    Both frames have vec_id, label and whole-number ``terms``; rows with a null
    among them take no part.
    """
    spark = rows.sparkSession
    known = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("terms").isNotNull()
    plain = lambda d: d.where(known).select(
        F.size("terms").alias("width"), F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.col("terms").cast("array<double>").alias("terms"))
    rows = staged(plain(rows), "mining-rows")
    first = plain(anchors).groupBy("id").agg(F.min(F.struct("label", "terms", "width")).alias("f"))
    asked = staged(first.select("id", "f.*").withColumn("limits", F.array().cast("array<long>")), "mining-anchors")
    total, cores = rows.count(), spark.sparkContext.defaultParallelism
    segments = max(1, -(-total // segment), min(cores, -(-total // LEAST_SEGMENT)))
    batches = max(1, -(-asked.count() // BATCH))

    near = _in_segments(_visits(rows, asked, segments, batches),
                        lambda s, ids, labels, terms, _: s.positives(ids, labels, terms, positives))
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    chosen = staged(near.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= positives).drop("__n"), "positives")
    limits = chosen.groupBy(F.col("anchor").alias("id")).agg(F.collect_list("score").alias("limits"))
    pairs = _in_segments(_visits(rows, asked.drop("limits").join(limits, "id"), segments, batches),
                         lambda s, ids, labels, terms, limits: s.negatives(ids, labels, terms, limits, negatives, percent))

    def keys(df: DataFrame, kind: int):
        return df.rdd.map(lambda r: (pack(r["anchor"], r["score"], kind, r["id"]), None))

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys(chosen, POSITIVE).union(keys(pairs, NEGATIVE)).repartitionAndSortWithinPartitions(partitions, anchor_hash)
    return spark.createDataFrame(ordered.mapPartitions(lambda part: windows((k for k, _ in part), negatives, percent)), RESULT)


def digest(embeddings: DataFrame, every: int = 100, noisy: int = 7, classes: int = 10) -> DataFrame:
    """Hard negatives of every 100th vector id; the label of every 7th id is moved
    on by one first."""
    label = F.when(F.col("vec_id") % noisy == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    rows = whole_vectors(embeddings.select("vec_id", "label", "embedding")).select("vec_id", label.alias("label"), "terms")
    return mined(rows, rows.where(F.col("vec_id") % every == 0))


#: The same result for one vector width, in DuckDB.
DIGEST_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.t, c.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
