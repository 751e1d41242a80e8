"""Repeated word passages across documents, found with an FM-index per shard.

Documents are cut into segments: runs of windows (13 words) with the same
smallest 3-word hash, the segment's key. Equal windows have equal keys, so every
repeat of a window is inside one shard of keys and shards are independent; work
grows in proportion to the input. Keys of one document only hold no repeat and
go no further, so whole segments travel only for keys that several share.

A shard holds each distinct segment once, owned by its smallest document id. An
FM-index over the segments' words gives, by backward search, the matching
statistics of every segment against smaller documents; maximal matches of 13 or
more words are reported. For a larger document with the same segment all of it
is a match.

A key of more than ``HOT`` segments is not indexed: its windows are grouped by
128-bit hashes of their words. Of equal windows in one batch of documents only
those of the smallest id are dealt by hash, the others are matches already, so a
passage comes to one task once per batch, and that task keeps its smallest id only.
Words must match byte by byte; windows are judged on the input. Null, empty and short texts have no window. Rows with a null id neither
give nor lose words; ids are taken as unique, rows that repeat an id with
another text get the removals of both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fleethealth.llm.fm_index import FMIndex
from fleethealth.llm.store import staged, whole_groups
from fleethealth.llm.text import Words, mix, pieces, rolled, text_bytes

GRAM = 3
LONGEST = 11  # windows in a segment
HOT = 10_000
SHARD_ROWS = 12_000


def _window_keys(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each window that lies in one text, its key)."""
    grams = rolled(words.code, GRAM)
    width = window - GRAM + 1
    least, have = grams, 1
    while have * 2 <= width:
        least, have = np.minimum(least[:-have], least[have:]) if len(least) > have else least[:0], have * 2
    if have < width and len(least):
        least = np.minimum(least[:len(least) - (width - have)], least[width - have:])
    n = len(words.code)
    # Words up to the end of the text that each word is in.
    rest = np.repeat(words.first[1:], np.diff(words.first)) - np.arange(n)
    begin = np.flatnonzero(rest >= window)
    return begin, least[begin].view(np.int64) if len(begin) else np.empty(0, np.int64)


def _segments(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, key) of each segment."""
    begin, key = _window_keys(words, window)
    if not len(begin):
        return begin, begin, key
    fresh = np.append(True, (key[1:] != key[:-1]) | (begin[1:] != begin[:-1] + 1))
    head = np.flatnonzero(fresh)
    inside = np.arange(len(begin)) - np.repeat(head, np.diff(np.append(head, len(begin))))
    head = np.flatnonzero(inside % LONGEST == 0)  # a run of one key may be long
    return begin[head], np.diff(np.append(head, len(begin))), key[head]


def _spans(documents: DataFrame, window: int) -> DataFrame:
    """(key, doc_id, span) of every segment; span is first word * 16 + windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch["text"])
            ids = batch["doc_id"].to_numpy()
            for i, part, off in pieces(data, at):
                words = Words(part, off)
                first, many, key = _segments(words, window)
                text = np.searchsorted(words.first, first, "right") - 1
                span = (first - words.first[text]) * 16 + many
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids[i + text]), pa.array(span)], names=["key", "doc_id", "span"])

    return documents.mapInArrow(run, "key long, doc_id long, span long")


def _shared(spans: DataFrame) -> DataFrame:
    """Rows of keys that more than one document has; ``hot`` marks the last row
    of a key with more than ``HOT`` of them. A stream over sorted rows: only the
    rows of a key's first document wait."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc_id", "span"]
        wait = [np.empty(0, np.int64)] * 3
        open_key, seen, shared = None, 0, False
        for batch in batches:
            cols = [np.concatenate([w, batch[c].to_numpy()]) for w, c in zip(wait, names)]
            key, doc, _ = cols
            if not len(key):
                continue
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            tail = np.append(head[1:], len(key))
            both = doc[head] != doc[tail - 1]
            count = tail - head
            if key[0] == open_key:
                both[0] |= shared
                count[0] += seen
            keep = np.repeat(both, tail - head)
            hot = np.zeros(len(key), dtype=bool)
            hot[tail[(count > HOT) & both] - 1] = True
            open_key, shared = key[-1], bool(both[-1])
            if shared:
                seen, wait = int(count[-1]), [c[:0] for c in cols]
            else:
                seen, wait = 0, [c[head[-1]:] for c in cols]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[keep]) for c in cols), pa.array(hot[keep])], names=[*names, "hot"])

    return spans.repartition("key").sortWithinPartitions("key", "doc_id").mapInArrow(
        run, "key long, doc_id long, span long, hot boolean")


def _listed(batch: pa.RecordBatch, *columns: str) -> Iterator[tuple]:
    """(words, raw bytes, id and text of each span, its first word, windows, other columns) of runs of texts."""
    data, at = text_bytes(batch["text"])
    ids = batch["doc_id"].to_numpy()
    lists = batch["spans"]
    ends = lists.offsets.to_numpy()
    span, *more = (lists.values.field(c).to_numpy(zero_copy_only=False) for c in ("span", *columns))
    for i, part, off in pieces(data, at):
        lo, hi = int(ends[i]), int(ends[i + len(off) - 1])
        text = np.repeat(np.arange(len(off) - 1), np.diff(ends[i:i + len(off)]))
        yield Words(part, off), part, ids[i + text], text, span[lo:hi] // 16, span[lo:hi] % 16, *(c[lo:hi] for c in more)


def _cut_out(rows: DataFrame, window: int) -> DataFrame:
    """(key, doc_id, first word, words of the segment) from texts with their spans."""
    schema = "key long, doc_id long, first int, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, part, ids, text, first, many, key in _listed(batch, "key"):
                start = words.begin[words.first[text] + first]
                stop = words.end[words.first[text] + first + many + window - 2]
                raw = part.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(ids), pa.array(first.astype(np.int32)),
                     pa.array([raw[a:b] for a, b in zip(start.tolist(), stop.tolist())], pa.binary())],
                    names=["key", "doc_id", "first", "words"])

    return rows.mapInArrow(run, schema)


def _windows(rows: DataFrame, window: int) -> DataFrame:
    """(h1, h2, doc_id, first word, hit) of each window of the spans, with two hashes
    of its words. ``hit``: a smaller document of the batch has it; h1 is free then."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for words, _, ids, text, first, many in _listed(batch):
                step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                first = np.repeat(first, many) + step
                at = np.repeat(words.first[text], many) + first
                h1, h2 = (rolled(c, window).view(np.int64) for c in (words.code, mix(words.code)))
                parts.append((h1[at], h2[at], np.repeat(ids, many), first))
            if not parts:
                continue
            h1, h2, doc, first = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort([doc, h2, h1])
            h1, h2, doc, first = h1[order], h2[order], doc[order], first[order]
            head = np.flatnonzero(_fresh(h1, h2))
            hit = doc > np.repeat(doc[head], np.diff(np.append(head, len(doc))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(hit, doc, h1)), pa.array(np.where(hit, 0, h2)), pa.array(doc), pa.array(first.astype(np.int32)), pa.array(hit)],
                names=["h1", "h2", "doc_id", "first", "hit"])

    return rows.mapInArrow(run, "h1 long, h2 long, doc_id long, first int, hit boolean")


def _fresh(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return np.append(np.ones(min(1, len(h1)), dtype=bool), (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))


def _matched_windows(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, begin, end) of the windows that a smaller document has too. A
    stream over sorted rows: only the smallest id of the open window waits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_window, owner = None, 0
        for batch in batches:
            h1, h2, doc, first = (batch[c].to_numpy() for c in ("h1", "h2", "doc_id", "first"))
            hit = batch["hit"].to_numpy(zero_copy_only=False)
            own = np.flatnonzero(~hit)
            found = [np.flatnonzero(hit)]
            if len(own):
                a, b, d = h1[own], h2[own], doc[own]
                head = np.flatnonzero(_fresh(a, b))
                least = d[head]
                if (a[0], b[0]) == open_window:
                    least[0] = owner
                found.append(own[d > np.repeat(least, np.diff(np.append(head, len(d))))])
                open_window, owner = (a[-1], b[-1]), least[-1]
            at = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[at]), pa.array(first[at]), pa.array(first[at] + np.int32(window))], names=["doc_id", "begin", "end"])

    dealt = _windows(rows, window).repartition("h1", "h2").sortWithinPartitions("h1", "h2", "doc_id")
    return dealt.mapInArrow(run, "doc_id long, begin int, end int")


def _matched(segments: DataFrame, window: int) -> DataFrame:
    """(doc_id, begin, end): word spans that a smaller document has too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in whole_groups(batches, ["key"], least=SHARD_ROWS):
            doc, first = shard["doc_id"].to_numpy(), shard["first"].to_numpy().astype(np.int64)
            text = shard["words"].cast(pa.large_binary()).combine_chunks()
            _, offsets, data = text.buffers()
            at = np.frombuffer(offsets, dtype=np.int64)[text.offset:text.offset + len(text) + 1]
            words = Words(np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0])
            size = np.diff(words.first)
            # One code per segment: its words in order, whatever stands between them.
            weight = np.arange(int(size.max()), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
            place = np.arange(len(words.code)) - np.repeat(words.first[:-1], size)
            run_ = np.concatenate([[np.uint64(0)], np.cumsum((words.code ^ (words.code >> np.uint64(29))) * weight[place])])
            code = run_[words.first[1:]] - run_[words.first[:-1]] + size.astype(np.uint64)
            order = np.lexsort([doc, code])
            fresh = np.append(True, code[order][1:] != code[order][:-1])
            owner_row = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            later = doc[order] != doc[owner_row]
            rows = order[later]
            out = [(doc[rows], first[rows], first[rows] + size[rows])]
            distinct = order[fresh]
            symbols = np.unique(words.code, return_inverse=True)[1]
            picked = np.concatenate([np.empty(0, np.int64), *(symbols[words.first[d]:words.first[d + 1]] for d in distinct.tolist())])
            ends = np.concatenate([[0], np.cumsum(size[distinct])])
            rank = np.unique(doc, return_inverse=True)[1]
            index = FMIndex(picked, ends, rank[distinct], int(symbols.max()) + 1)
            which, begin, end = index.matches(rank[distinct], window)
            # The owner may hold the same segment in several places.
            group = (np.cumsum(fresh) - 1)[~later]
            own, head = order[~later], np.searchsorted(group, which)
            times = np.searchsorted(group, which, "right") - head
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row = own[np.repeat(head, times) + step]
            out.append((doc[row], first[row] + np.repeat(begin, times), first[row] + np.repeat(end, times)))
            d, b, e = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(d), pa.array(b.astype(np.int32)), pa.array(e.astype(np.int32))], names=["doc_id", "begin", "end"])

    dealt = segments.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "doc_id long, begin int, end int")


def repeated_spans(documents: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, begin, end) word spans covered by windows that begin in a document
    of smaller id as well; ``documents`` has doc_id (long) and text.

    Exact copies are set apart first: of equal texts only the one with the
    smallest id is searched, the others are covered whole.
    """
    known = documents.where("doc_id IS NOT NULL AND text IS NOT NULL")
    digest = [F.xxhash64("text").alias("h1"), F.crc32("text").alias("h2"), F.octet_length("text").alias("h3")]
    copies = known.select("doc_id", *digest)
    firsts = staged(copies.groupBy("h1", "h2", "h3").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1"), "copied")
    later = staged(copies.join(firsts, ["h1", "h2", "h3"]).where("doc_id > first_id").select("doc_id"), "later-copies")
    shared = staged(_shared(_spans(known.select("doc_id", "text"), window)).join(later, "doc_id", "left_anti"), "shared")
    hot = shared.where("hot").select("key").distinct()

    def with_spans(rows: DataFrame, *columns: str) -> DataFrame:
        lists = rows.groupBy("doc_id").agg(F.collect_list(F.struct("span", *columns)).alias("spans"))
        return known.select("doc_id", "text").join(lists, "doc_id")

    if hot.isEmpty():
        found = _matched(_cut_out(with_spans(shared, "key"), window), window)
    else:
        found = _matched(_cut_out(with_spans(shared.join(F.broadcast(hot), "key", "left_anti"), "key"), window), window).unionByName(
            _matched_windows(with_spans(shared.join(F.broadcast(hot), "key", "left_semi")), window))
    whole = later.select("doc_id", F.lit(0).alias("begin"), F.lit((1 << 31) - 1).alias("end"))
    return staged(found.unionByName(whole), "spans")


def _apply(documents: DataFrame, window: int, columns: dict, fn) -> DataFrame:
    """``documents`` with columns that ``fn(words, removed)`` gives for each text."""
    base = documents.withColumn("__id", F.col("doc_id").cast("long"))
    spans = repeated_spans(base.select(F.col("__id").alias("doc_id"), "text"), window)
    lists = spans.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_list(F.struct("begin", "end")).alias("__spans"))
    joined = base.join(lists, "__id", "left").drop("__id")
    schema = T.StructType([f for f in joined.schema.fields if f.name not in ("__spans", *columns)]
                          + [T.StructField(n, t) for n, t in columns.items()])
    kept = [f.name for f in schema.fields[:-len(columns)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"].to_pylist(), batch["__spans"].to_pylist()):
                words = text.encode().split() if text else []
                removed = np.zeros(len(words) + 1, dtype=np.int64)
                if len(words) >= window:
                    for s in spans or ():
                        removed[s["begin"]] += 1
                        removed[min(s["end"], len(words))] -= 1
                out.append(fn(text, words, np.cumsum(removed[:-1]) > 0))
            cols = list(zip(*out)) or [()] * len(columns)
            arrays = [pa.array(c, k) for c, k in zip(cols, fn.kinds)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *arrays], names=schema.names)

    return joined.mapInArrow(run, schema)


def _figures(text, words, removed):
    left = [w for w, r in zip(words, removed.tolist()) if not r] if removed.any() else words
    return len(words), int(removed.sum()), hashlib.sha256(b" ".join(left)).hexdigest()


def _rest(text, words, removed):
    if not removed.any():
        return (text,)
    return (b" ".join([w for w, r in zip(words, removed.tolist()) if not r]).decode(),)


_figures.kinds = (pa.int64(), pa.int64(), pa.string())
_rest.kinds = (pa.string(),)


def digest(documents: DataFrame, window: int = 13) -> DataFrame:
    """Word counts and the checksum of what is left of each text."""
    columns = {"n_words": T.LongType(), "n_removed": T.LongType(), "kept_sha256": T.StringType()}
    return _apply(documents.select("doc_id", "text"), window, columns, _figures).drop("text")


def without_repeats(documents: DataFrame, window: int = 13) -> DataFrame:
    """``documents`` with repeated passages taken out of ``text``; texts that lose
    words are joined by single spaces, others stay as they are."""
    return _apply(documents, window, {"text": T.StringType()}, _rest).select(*documents.columns)


#: The same result in DuckDB.
DIGEST_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13
), seq AS (SELECT doc_id, i, list_aggregate(ws[i:i + 12], 'string_agg', ' ') AS s FROM win),
low AS (SELECT s, min(doc_id) AS d FROM seq GROUP BY s HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, i FROM seq JOIN low USING (s) WHERE doc_id > d),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 13)))) AS g FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(g), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(list_aggregate(CASE WHEN g IS NULL THEN ws ELSE
         list_select(ws, list_filter(range(1, len(ws) + 1), lambda k: NOT list_contains(g, k))) END, 'string_agg', ' '), ''))
         AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
