"""Ranked lexical search by sequential reads only (no random access).

A term's postings are ordered by falling impact, so a prefix of the list holds
the documents it can help most. Every query reads its lists in steps: all
postings that add at least ``level`` to a score, then ``level`` is halved. A
document's score lies between the sum of what was read of it (lower) and that sum
plus, for every list in which it was not met so far, what the next posting of the
list adds (upper). Reading goes on until

* no unread document can reach the k-th best lower score (membership),
* no met document outside the k best can reach or equal it (ties), and
* lower and upper score of all that can are one number (final scores).

The index is partitioned by documents: a shard has the postings of its rows for
the terms that are asked for, about ``SHARD`` of them, however frequent a term is.
Each shard resolves its own k best of each query and these are merged by query.

Queries are taken in blocks of about ``BLOCK_BYTES`` of text; only a block's
terms and weights are sent to the tasks, and a block reads the documents once. All
scores are 64-bit integers.

Rows with a null text or without terms are no documents. Rows with a null
document id count in the statistics and are not ranked; repeated ids are
documents of their own. Queries with a null id are left out, repeated query ids
are answered one by one, null and empty queries find nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from fleethealth.llm.store import staged
from fleethealth.llm.text import _LOWER, pieces, text_bytes

SHARD, LEAST_SHARD = 1 << 20, 1 << 15
BLOCK_BYTES = 32 << 20
CHUNK = 1 << 22
RESULT = "__query int, item_id long, doc_id long, score long"

# Terms are runs of ASCII letters and digits and of all other than ASCII characters.
_TERM = np.zeros(256, dtype=bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms_of(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(terms of all texts in order, A-Z lower-cased; index of each text's first
    with one more entry)."""
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:-1]
    place = np.flatnonzero(begin)
    kept = _LOWER[data[inside]]
    before = np.append(0, np.cumsum(inside))
    cuts = np.append(before[place], len(kept)).astype(np.int32)
    return pa.StringArray.from_buffers(len(place), pa.py_buffer(cuts), pa.py_buffer(kept)), np.searchsorted(place, at)


def scanned(docs: DataFrame, asked: pa.Array, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tf) of every row: its number of terms, and index and
    frequency of those in ``asked``."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)
    many = max(1, len(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in pieces(*text_bytes(batch.column(1)), CHUNK):
                n = len(at) - 1
                words, first = terms_of(data, at)
                place = pc.index_in(words, value_set=shared.value).fill_null(-1).to_numpy()
                hit = np.flatnonzero(place >= 0)
                doc = np.searchsorted(first, hit, "right") - 1
                pairs, tf = np.unique(doc * many + place[hit], return_counts=True)
                ends = pa.array(np.searchsorted(pairs, np.arange(n + 1) * many).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, n), pa.array(np.diff(first)),
                     pa.ListArray.from_arrays(ends, pa.array((pairs % many).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int64)))], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, "doc_id long, n long, terms array<int>, tf array<long>")


class Postings:
    """Impact-ordered postings of one shard."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int) -> None:
        order = np.lexsort((doc, -impact, term))
        self.ids, self.doc, self.less = ids, doc[order], -impact[order]
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))

    def search(self, terms: Sequence[int], weights: Sequence[int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores, postings read): the ``k`` best rows with a score above 0,
        best first, ties to the smaller id."""
        lists = [(self.doc[a:b], self.less[a:b], w)
                 for a, b, w in ((self.first[t], self.first[t + 1], w) for t, w in zip(terms, weights)) if w > 0 and a < b]
        read, bound = [0] * len(lists), [int(-less[0]) * w for _, less, w in lists]
        lower = np.zeros(len(self.ids), np.int64)
        level = max(bound, default=0)
        while True:
            level //= 2
            for i, (doc, less, w) in enumerate(lists):
                if bound[i] < max(level, 1) and level:
                    continue
                # Sequential: from where this list was left, down to the level.
                end = int(np.searchsorted(less, -(-(-level // w)), "right")) if level else len(less)
                lower[doc[read[i]:end]] += less[read[i]:end] * -w
                read[i], bound[i] = end, int(-less[end]) * w if end < len(less) else 0
            rest = sum(bound)
            # Scores start above 0, so an empty place is worth 1.
            kth = max(1, int(np.partition(lower, -k)[-k])) if len(lower) >= k else 1
            if rest >= kth:
                continue
            upper = lower + rest
            for (doc, _, _), end, b in zip(lists, read, bound):
                if b:
                    upper[doc[:end]] -= b
            able = np.flatnonzero(upper >= kth)
            if (upper[able] == lower[able]).all():
                best = able[np.lexsort((self.ids[able], -lower[able]))][:k]
                return self.ids[best], lower[best], sum(read)


def _impacts(n: np.ndarray, tf: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Share of a term's weight that ``tf`` occurrences in a text of ``n`` terms earn."""
    if 75 * int(n.max(initial=0)) * documents >= 1 << 63 or int(tf.max(initial=0)) * 10 ** 9 >= 1 << 63:
        raise ValueError("lengths beyond 64-bit integers")
    m = 25 + 75 * n * documents // length
    return tf * 1_000_000_000 // (1000 * tf + 8 * m)


def _block(docs: DataFrame, items: list[tuple[int, str]], k: int, shard: int, number: int) -> DataFrame | None:
    """The ``k`` best rows of each shard for each of ``items``."""
    spark = docs.sparkSession
    words, first = terms_of(*text_bytes(pa.array([t for _, t in items], pa.large_string())))
    asked = pc.unique(words)
    if not len(asked):
        return None
    code = pc.index_in(words, value_set=asked).to_numpy()
    rows = staged(scanned(docs, asked), f"search-{number}")
    documents, length, postings = rows.agg(
        F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0)),
        F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    if not postings:
        return None
    held = np.zeros(len(asked), np.int64)  # documents of each asked term; terms of the block only
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        held[r["t"]] = r["count"]
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in held]
    queries = []
    for i, (item, _) in enumerate(items):
        own, many = np.unique(code[first[i]:first[i + 1]], return_counts=True)
        queries.append((item, own.tolist(), [weight[t] * int(m) for t, m in zip(own, many)]))
    shared = spark.sparkContext.broadcast(queries)
    cores = spark.sparkContext.defaultParallelism
    shards = max(-(-postings // shard), min(cores, -(-postings // LEAST_SHARD)))
    dealt = rows.where((F.size("terms") > 0) & F.col("doc_id").isNotNull()).select(
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(shards)).alias("shard"), "*").repartition(
        shards, "shard")
    n_terms = len(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A hash may bring two shards to one task; they are one larger shard then.
        t = pa.Table.from_batches(list(batches), _SCANNED)
        if not t.num_rows:
            return
        size = pc.list_value_length(t["terms"]).to_numpy()
        tf = pc.list_flatten(t["tf"]).to_numpy()
        impact = _impacts(np.repeat(t["n"].to_numpy(), size), tf, documents, length)
        index = Postings(t["doc_id"].to_numpy(), np.repeat(np.arange(len(size), dtype=np.int32), size),
                         pc.list_flatten(t["terms"]).to_numpy(), impact, n_terms)
        del t, tf, impact
        for q, (item, terms, weights) in enumerate(shared.value):
            ids, scores, _ = index.search(terms, weights, k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), q, np.int32)), pa.array(np.full(len(ids), item, np.int64)),
                 pa.array(ids), pa.array(scores)], names=["__query", "item_id", "doc_id", "score"])

    return dealt.select("doc_id", "n", "terms", "tf").mapInArrow(run, RESULT).withColumn("__block", F.lit(number))


_SCANNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))])


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, item_key: str = "item_id", item_text: str = "text",
           block_bytes: int = BLOCK_BYTES, shard: int = SHARD) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` rows of ``docs`` (doc_id, text)
    that score highest for each text of ``items``, with scores above 0."""
    spark = docs.sparkSession
    asked = items.where(F.col(item_key).isNotNull() & (F.octet_length(item_text) > 0)).select(
        F.col(item_key).cast("long").alias("id"), F.col(item_text).alias("text"))
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    found = []
    for b in range(blocks):
        # One block at a time: at most about block_bytes, or one longer text.
        own = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        part = _block(docs, [tuple(r) for r in own], k, shard, b)
        if part is not None:
            found.append(part)
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("__block", "__query").orderBy(F.desc("score"), "doc_id")
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


#: The same result in DuckDB.
DIGEST_SQL = """
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents
), p AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL
), d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM p GROUP BY doc_id
), c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d
), f AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight
  FROM p, c GROUP BY term, n_docs
), q AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), s AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * n_docs) // n_terms))))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN p USING (term) JOIN d USING (doc_id), c
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER o AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER o <= 10
"""
