"""Exact top-k inner products by block-at-a-time pruning.

Vectors are whole numbers per term (component). They are ordered so that similar
vectors are neighbours and cut into blocks; a block keeps the largest and the
smallest value of each term and a forward index of its vectors. The bound of a
block for a query is the sum over terms of the larger of query value times
maximum and times minimum. A query visits blocks in falling order of their
bounds, scores each whole block, and stops when the next bound is below its
k-th score so far (equal bounds are still scored, for ties).

Segments of blocks are the unit of distribution; all queries go to all segments
in batches, and the k best of each segment are merged by query. Nothing is
broadcast: queries reach a segment by a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fleethealth.llm.store import staged, whole_groups

BLOCK, SEGMENT, BATCH = 64, 8_192, 4_096
RESULT = "query_id long, vec_id long, score long"


def whole_numbers(df: DataFrame, vector: str = "embedding", scale: int = 256) -> DataFrame:
    """floor(scale * x) per component as ``terms``; rows whose vector is null or
    holds null or non-finite components are left out."""
    x = F.col(vector)
    finite = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return df.where(F.coalesce(finite, F.lit(False))).withColumn(
        "terms", F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")))


class Blocks:
    """The blocks of one segment."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, block: int = BLOCK) -> None:
        # Neighbours by the signs of the strongest terms, then by the strongest value.
        strong = np.argsort(-np.abs(terms).sum(axis=0), kind="stable")[:16]
        order = np.lexsort([ids, *(terms[:, j] > 0 for j in strong[::-1])]) if terms.shape[1] else np.argsort(ids)
        self.ids, self.terms = ids[order], terms[order].astype(np.float64)
        self.starts = np.arange(0, len(ids), block)
        self.block = block
        self.top = np.maximum.reduceat(self.terms, self.starts, axis=0)
        self.low = np.minimum.reduceat(self.terms, self.starts, axis=0)
        size = np.abs(self.terms).max(initial=0)
        self.exact = size * size * max(1, terms.shape[1]) < 2 ** 52
        self.whole = terms[order]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        return up @ self.top.T + down @ self.low.T

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the k best rows of each query, without the query's own id."""
        as_float = queries.astype(np.float64)
        bounds = self.bounds(as_float)
        visit = np.argsort(-bounds, axis=1, kind="stable")
        for q in range(len(queries)):
            ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
            kth, step, at = None, 1, 0
            while at < len(self.starts):
                blocks = visit[q, at:at + step]
                # A rounded sum of products could lie half a unit low.
                blocks = blocks if kth is None else blocks[bounds[q, blocks] >= kth - 0.5]
                if not len(blocks):
                    break
                rows = (self.starts[blocks][:, None] + np.arange(self.block)).ravel()
                rows = rows[rows < len(self.ids)]
                rows = rows[self.ids[rows] != own[q]]
                got = (self.terms[rows] @ as_float[q]).astype(np.int64) if self.exact else self.whole[rows] @ queries[q]
                ids, scores = np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, got])
                if len(ids) > k:
                    best = np.lexsort([ids, -scores])[:k]
                    ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    kth = scores.min()
                at, step = at + step, min(16, step * 2)
            yield ids, scores


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", segment: int = SEGMENT,
          batch: int = BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``vectors`` for each
    of ``queries``, ties to the smaller id, the query's own id left out.

    Both frames have ``key`` and whole-number ``terms`` of one length; a query of
    another length than a vector does not meet it. Rows with a null key take no
    part. Repeated ids are candidates each on their own; repeated queries count once.
    """
    width = F.size("terms").alias("width")
    rows = staged(vectors.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), "terms", width), "vectors")
    asked = staged(queries.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), "terms", width).dropDuplicates(["id"]), "vector-queries")
    segments = max(1, -(-rows.count() // segment))
    batches = max(1, -(-asked.count() // batch))
    place = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(segments))
    left = rows.select("width", place.alias("segment"), F.lit(-1).alias("batch"), "id", "terms")
    # Each query once per segment: the stated query set against all rows, in blocks.
    right = asked.select(
        "width", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(segments - 1).cast("long"))).alias("segment"),
        F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int").alias("batch"), "id", "terms")
    dealt = left.unionByName(right).repartition(segments, "width", "segment").sortWithinPartitions(
        "width", "segment", "batch")

    def run(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, blocks = None, None
        for t in whole_groups(arrow, ["width", "segment", "batch"]):
            keys = np.stack([t[c].to_numpy() for c in ("width", "segment", "batch")], axis=1)
            cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
                part = t.slice(a, b - a).combine_chunks()
                ids = part["id"].to_numpy()
                flat = part["terms"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
                terms = flat.reshape(len(ids), int(keys[a][0]))
                if keys[a][2] == -1:
                    held, blocks = tuple(keys[a][:2]), Blocks(ids, terms)
                    continue
                if held != tuple(keys[a][:2]):
                    continue  # no vector of this width here
                for i in range(0, len(ids), 512):
                    found = list(blocks.search(ids[i:i + 512], terms[i:i + 512], k))
                    many = np.array([len(x) for x, _ in found])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[i:i + 512], many)), pa.array(np.concatenate([x for x, _ in found])),
                         pa.array(np.concatenate([s for _, s in found]))], names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return dealt.mapInArrow(run, RESULT).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def digest(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Top 5 of every 50th vector id against all rows."""
    numbers = whole_numbers(embeddings.select("vec_id", "embedding")).select("vec_id", "terms")
    return top_k(numbers, numbers.where(F.col("vec_id") % every == 0), k)


#: The same result for one vector width, in DuckDB.
DIGEST_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.t, c.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""
