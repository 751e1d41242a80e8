"""Near-duplicate groups by MinHash and a multi-index Hamming join.

Texts are sets of word shingles. Equal sets are one class from the start, and
only the classes go on. A class has a signature of 36 b-bit minhashes (b = 16),
cut into 9 chunks of 4. By the pigeonhole principle two signatures that differ
in at most 17 places have a chunk with at most one error; so each chunk is
entered four times, once per place that may be wrong, and every pair within
that distance meets under a common key. Two sets of similarity 0.75 stay apart
with probability 6e-6.

All pairs under a key are never made. First each member is compared with the
key's smallest member; links that hold on the full shingle sets join components.
Keys whose members are then still in several components are compared again with
another leader, and at last block by block: only pairs of different components,
each under the first key that it shares, only if its signatures do not rule it
out (a pair of similarity 0.75 differs in more than 24 of 36 places with
probability 3e-8), and within the block, so that no such pair leaves the task
but those that join two components. So every pair that meets is either compared
on full sets or already connected.

Texts without words have an empty set and no link. Rows with a null id have
class and component null. Rows of one id are one node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleethealth.llm.components import components
from fleethealth.llm.store import staged, whole_groups
from fleethealth.llm.text import U64, Words, mix, pieces, shingle_sets, text_bytes

CHUNKS, PLACES, BITS = 9, 4, 16
HASHES = CHUNKS * PLACES
RULED_OUT = 24
BLOCK = 512
PORTIONS = 1024
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=U64)) | U64(1)
_MASK = (1 << BITS) - 1


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 36 b-bit minhashes of a set, four to a 64-bit number."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=U64)
    for i in range(0, len(shingles), 1 << 15):
        part = shingles[i:i + (1 << 15)]
        np.minimum(least, (part[None, :] * _FACTORS[:, None]).min(axis=1), out=least)
    values = (mix(least) >> U64(64 - BITS)).reshape(CHUNKS, PLACES)
    return sum(values[:, p] << U64(BITS * p) for p in range(PLACES)).astype(np.int64)


def shingled(documents: DataFrame, k: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, d1, d2, signature): size, 128-bit digest and signature of each text's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch["text"])
            for i, part, off in pieces(data, at):
                sizes, digests, signatures = [], [], []
                for s in shingle_sets(Words(part, off, lower=True), k):
                    sizes.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    signatures.append(signature(s) if len(s) else None)
                d = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(i, len(sizes)), pa.array(sizes, pa.int64()), pa.array(d[:, 0].copy()),
                     pa.array(d[:, 1].copy()), pa.array(signatures, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "d1", "d2", "signature"])

    return documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_shingles long, d1 long, d2 long, signature array<long>")


def _keys() -> Column:
    """All keys of a signature: each chunk with each of its places blanked."""
    return F.array(*[
        F.xxhash64(F.lit(c * PLACES + p), F.get("signature", F.lit(c)).bitwiseAND(
            F.lit(np.int64(np.uint64(~(_MASK << (BITS * p)) & (2 ** 64 - 1)).astype(np.int64)).item())))
        for c in range(CHUNKS) for p in range(PLACES)])


def _apart(a: str, b: str) -> Column:
    """Places in which two signatures differ."""
    total = F.lit(0)
    for c in range(CHUNKS):
        x = F.get(a, F.lit(c)).bitwiseXOR(F.get(b, F.lit(c)))
        for p in range(PLACES):
            total = total + (F.shiftrightunsigned(x, BITS * p).bitwiseAND(F.lit(_MASK)) != 0).cast("int")
    return total


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that size and signature do not rule out."""
    side = lambda s: classes.select(F.col("rep").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"s_{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.where(
        (F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent) & (_apart("s_a", "s_b") <= RULED_OUT)
    ).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The (a, b) whose full shingle sets reach ``percent`` of their union.

    The partners of a leader ``a`` are dealt over portions; a task holds one
    leader's set while a portion streams by.
    """
    dealt = staged(pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(PORTIONS)).alias("portion")), "pairs")
    needed = dealt.select("a", "portion", F.lit(1).alias("role"), F.col("b").alias("rep")).unionByName(
        dealt.select("a", "portion", F.lit(0).alias("role"), F.col("a").alias("rep")).distinct())
    rows = needed.join(texts, "rep").repartition("a", "portion").sortWithinPartitions("a", "portion", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, leader = None, []
        for batch in batches:
            a, portion, role, rep = (batch[c].to_pylist() for c in ("a", "portion", "role", "rep"))
            data, at = text_bytes(batch["text"])
            out = []
            for i, part, off in pieces(data, at):
                for r, own in enumerate(shingle_sets(Words(part, off, lower=True), k), i):
                    if (a[r], portion[r]) != here:
                        here, leader = (a[r], portion[r]), []
                    if role[r] == 0:
                        leader.append(own)
                        continue
                    for other in leader:
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        if both * 100 >= percent * (len(own) + len(other) - both):
                            out.append((a[r], rep[r]))
                            break
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], names=["a", "b"])

    return staged(rows.select("a", "portion", "role", "rep", "text").mapInArrow(run, "a long, b long").distinct(), "links")


def _first_shared(same: np.ndarray) -> np.ndarray:
    """The first key (chunk and blanked place) that pairs share, from which places are equal."""
    same = same.reshape(-1, CHUNKS, PLACES)
    others = same.sum(axis=2, keepdims=True) - same == PLACES - 1
    return others.reshape(-1, HASHES).argmax(axis=1)


def _common(own: np.ndarray, flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many of a sorted set's members each of several sets has."""
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    values = flat[np.repeat(first, size) + step]
    hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
    return np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)


def _rest(members: DataFrame, classes: DataFrame, sizes: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links between different components under one key, compared block by block."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    entry = members.join(sizes, "key").join(classes.select("rep", "signature"), "rep").withColumn("own", own)
    # A member meets every block once: with itself in the role of row or column.
    spread = entry.select("key", "slot", "rep", "component", "signature", "own", F.explode(
        F.sequence(F.lit(0), blocks - 1)).alias("other")).select(
        "key", "slot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "rep", "component",
        "signature")
    rows = spread.join(texts, "rep").select(
        "key", "slot", "i", "j", "own", "rep", "component", "signature", "text").repartition(
        "key", "i", "j").sortWithinPartitions("key", "i", "j", "own")

    def block(t: pa.Table, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
        marks = t["signature"].combine_chunks().flatten().to_numpy().view(np.uint16).reshape(-1, HASHES)
        rep, side, slot = t["rep"].to_numpy(), t["own"].to_numpy(), t["slot"][0].as_py()
        root = np.unique(t["component"].to_numpy(), return_inverse=True)[1]
        n = np.array([len(s) for s in sets])
        flat, first = np.concatenate(sets), np.cumsum(n) - n
        same = t["i"][0].as_py() == t["j"][0].as_py()
        left = np.flatnonzero(side == t["i"][0].as_py())
        right = np.flatnonzero(side != t["i"][0].as_py())
        a, b = [], []
        for x, r in enumerate(left.tolist()):
            to = left[x + 1:] if same else right
            to = to[(root[to] != root[r]) & (np.minimum(n[to], n[r]) * 100 >= percent * np.maximum(n[to], n[r]))]
            if not len(to):
                continue
            alike = marks[to] == marks[r]
            to = to[(alike.sum(axis=1) >= HASHES - RULED_OUT) & (_first_shared(alike) == slot)]
            if not len(to):
                continue
            both = _common(sets[r], flat, first[to], n[to])
            for y in to[both * 100 >= percent * (n[r] + n[to] - both)].tolist():
                if root[y] != root[r]:
                    root[root == root[y]] = root[r]
                    a.append(int(rep[r]))
                    b.append(int(rep[y]))
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["key", "i", "j"], least=512):
            key, i, j = (t[c].to_numpy() for c in ("key", "i", "j"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            a, b = [], []
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                part = t.slice(lo, hi - lo)
                if len(np.unique(part["component"].to_numpy())) < 2:
                    continue
                data, at = text_bytes(part["text"].combine_chunks())
                sets = [s for _, d, off in pieces(data, at) for s in shingle_sets(Words(d, off, lower=True), k)]
                x, y = block(part, sets)
                a += x
                b += y
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return staged(rows.mapInArrow(run, "a long, b long").distinct(), "links")


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 75, key: str = "doc_id", text: str = "text",
                    leaders: int = 1) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``documents``."""
    sets = staged(shingled(documents, k, key, text), "sets")
    classes = staged(
        sets.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()).groupBy("d1", "d2").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")),
        "classes")
    entries = classes.select("rep", F.posexplode(_keys()).alias("slot", "key"))
    shared = staged(entries.groupBy("key").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("size"))
                    .where("size > 1"), "keys")
    members = staged(entries.join(shared, "key").select("key", "slot", "rep", "lead", "size"), "members")
    ids = documents.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("text"))
    texts = staged(ids.join(members.select("rep").distinct(), "rep"), "texts")

    pairs = members.where(F.col("rep") != F.col("lead")).select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    links = confirmed(_possible(pairs, classes, percent), texts, k, percent)
    found = staged(components(links), "components")
    for turn in range(leaders + 1):
        label = F.coalesce("component", "rep").alias("component")
        placed = members.where("size > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "key", "slot", "rep", "size", label)
        open_keys = staged(placed.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.max("size").alias("size"),
            F.min_by("rep", F.xxhash64("rep", F.lit(turn))).alias("lead")).where("low < high"), "open-keys")
        inside = placed.drop("size").join(open_keys.select("key"), "key", "left_semi")
        if turn < leaders:
            large = open_keys.where(F.col("size") > BLOCK // 8)
            if large.isEmpty():
                continue
            lead = large.join(found.select(F.col("node").alias("lead"), F.col("component").alias("c")), "lead", "left").select(
                "key", F.col("lead").alias("a"), F.coalesce("c", "lead").alias("c"))
            pairs = inside.join(lead, "key").where(F.col("c") != F.col("component")).select("a", F.col("rep").alias("b")).distinct()
            more = confirmed(_possible(pairs, classes, percent), texts, k, percent)
        else:
            more = _rest(inside, classes, open_keys.select("key", "size"), texts, k, percent)
        if not more.isEmpty():
            links = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
            found = staged(components(links), "components")
    grouped = staged(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("component")), "grouped")
    component = F.when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("component", "doc_id"))
    return sets.join(grouped, ["d1", "d2"], "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def deduplicated(documents: DataFrame, **kw) -> DataFrame:
    """One document of each group: the one with the smallest id. Rows without an
    id stay; of rows that repeat an id all stay or go together."""
    gone = near_duplicates(documents, **kw).where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return documents.join(gone, "doc_id", "left_anti")


#: The same result in DuckDB, by counting common shingles of all pairs that have one.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5
    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY x, y
), links AS (
  SELECT x, y FROM pairs JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)
), ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, ways.y FROM reach JOIN ways ON ways.x = reach.other
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reach.other) AS component_id,
       min(reach.other) = d.doc_id AS kept
FROM documents d JOIN reach USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id, n.n
"""
