"""Quality scores by an additive model with pairwise interactions.

Every feature of a text is cut into bins. Cyclic boosting visits one feature at
a time, fits a shallow tree (at most four leaves) to the current residuals over
that feature's bins and adds its leaf values to the feature's lookup table; then
the strongest pairs of features get two-dimensional tables the same way. A score
is the logistic of an intercept plus one table entry per feature and pair.

Fitting takes a bounded sample of labelled rows (``max_rows``, chosen by hash of
the id) to the driver as feature rows, never texts; scoring is one pass over
whole texts without a shuffle.

Null and empty texts have all features 0 and are scored like any other. Rows
without a label are not learned from; without any usable label every score is
0.5. Labels of repeated ids all count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleethealth.llm.store import small_batches
from fleethealth.llm.text import Words, pieces, text_bytes

FEATURES = [
    "log_bytes", "log_words", "word_bytes", "upper", "digit", "stop_marks", "other_marks", "spaces", "not_ascii",
    "words_a_line", "distinct_words", "top_word", "distinct_pairs", "marks_alone", "marked_ends", "capital_words",
    "repeated_lines", "words_a_stop",
]
BINS, PAIR_BINS, PAIRS, ROUNDS, RATE = 32, 8, 12, 150, 0.15
MAX_ROWS = 20_000
THRESHOLD = 0.3

_KIND = np.full(256, 4, dtype=np.uint8)  # 0 lower, 1 upper, 2 digit, 3 stop mark, 4 other mark, 5 space, 6 not ASCII
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 6
_KIND[[ord(c) for c in ".,;:?'\""]] = 3
_KIND[[0x20, *range(0x09, 0x0E)]] = 5


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    run = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=run[1:])
    return run[at[1:]] - run[at[:-1]]


def _repeats(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the share of distinct codes and the share of the most frequent."""
    distinct, top = np.zeros(len(begin)), np.zeros(len(begin))
    for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
        if b > a:
            s = np.sort(codes[a:b])
            runs = np.diff(np.append(np.flatnonzero(np.append(True, s[1:] != s[:-1])), b - a))
            distinct[i], top[i] = len(runs) / (b - a), runs.max() / (b - a)
    return distinct, top


def features(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    w = Words(data, at)
    kind = _KIND[data]
    size = np.diff(at)
    n = np.diff(w.first)
    by_kind = [_sums(kind == k, at) for k in range(7)]
    letters = by_kind[0] + by_kind[1] + by_kind[6]
    ratio = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
    first, last = kind[w.begin], kind[w.end - 1]
    mark_run = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((kind == 3) | (kind == 4), out=mark_run[1:])
    alone = mark_run[w.end] - mark_run[w.begin] == w.end - w.begin
    distinct, top = _repeats(w.code, w.first[:-1], w.first[1:])
    pairs = w.code[:-1] * np.uint64(3) + w.code[1:] if len(w.code) > 1 else w.code[:0]
    # A text's last word begins no pair: the next word is another text's.
    pair_distinct, _ = _repeats(pairs, w.first[:-1], w.first[1:] - 1)
    line_feed = data == 10
    lines = _sums(line_feed, at) + 1
    cut = np.unique(np.concatenate([at, np.flatnonzero(line_feed) + 1]))
    line_first = np.searchsorted(w.begin, cut)
    run = np.zeros(len(w.code) + 1, dtype=np.uint64)
    np.cumsum(w.code, out=run[1:])
    # A line's code is the sum of its words' codes.
    line_code = run[line_first[1:]] - run[line_first[:-1]]
    line_at = np.searchsorted(cut, at)
    line_distinct, _ = _repeats(line_code, line_at[:-1], line_at[1:])
    out = np.stack([
        np.log1p(size), np.log1p(n), ratio(size - by_kind[5], n), ratio(by_kind[1], letters), ratio(by_kind[2], size),
        ratio(by_kind[3], size), ratio(by_kind[4], size), ratio(by_kind[5], size), ratio(by_kind[6], size),
        ratio(n, lines) * (n > 0), distinct, top, pair_distinct, ratio(_sums(alone, w.first), n),
        ratio(_sums((last == 4) & ~alone, w.first), n), ratio(_sums(first == 1, w.first), n),
        np.where(n > 0, 1 - line_distinct, 0.0), np.log1p(ratio(n, by_kind[3])),
    ], axis=1).astype(np.float64)
    out[size == 0] = 0
    return out


@dataclass
class Additive:
    """Bin edges, one table per feature and one per pair."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (e, t) in enumerate(zip(self.edges, self.tables)):
            total += t[np.searchsorted(e, x[:, j], "right")]
        if self.pairs:
            coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.pair_edges)]
            for (a, b), t in zip(self.pairs, self.pair_tables):
                total += t[coarse[a], coarse[b]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best gain and place of one cut along the last axis of 1-d sums."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gain = gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - g.sum() ** 2 / (h.sum() + 1)
    best = int(np.argmax(gain))
    return float(gain[best]), best + 1


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value per bin of a tree over ordered bins."""
    gain, at = _cut(g, h) if depth else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(g), g.sum() / (h.sum() + 1))
    return np.concatenate([_tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values of a two-level tree over a grid: a cut on one axis, then one
    on the other axis in each half; the better choice of first axis."""
    best, out = -np.inf, np.zeros_like(g)
    for flip in (False, True):
        a, b = (g.T, h.T) if flip else (g, h)
        for at in range(1, len(a)):
            halves = [(a[:at].sum(0), b[:at].sum(0)), (a[at:].sum(0), b[at:].sum(0))]
            values = [_tree(x, y, 1) for x, y in halves]
            gain = sum(float((v * x).sum()) for v, (x, _) in zip(values, halves))
            if gain > best:
                grid = np.concatenate([np.tile(values[0], (at, 1)), np.tile(values[1], (len(a) - at, 1))])
                best, out = gain, grid.T if flip else grid
    return out


def fit_rows(x: np.ndarray, y: np.ndarray) -> Additive:
    """The model of feature rows and 0/1 labels."""
    width = len(FEATURES)
    if not len(x):
        return Additive(0.0, [np.empty(0)] * width, [np.zeros(1)] * width)
    mean = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(mean / (1 - mean))), [_edges(x[:, j], BINS) for j in range(width)], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    total = np.full(len(x), model.intercept)

    def sums(place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(place, y - p, size), np.bincount(place, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            step = RATE * _tree(*sums(bins[j], len(table)))
            table += step
            total += step[bins[j]]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    sides = [len(e) + 1 for e in model.pair_edges]
    grid = lambda a, b: coarse[a] * sides[b] + coarse[b]
    strength = {}
    for a, b in combinations(range(width), 2):
        g, h = (s.reshape(sides[a], sides[b]) for s in sums(grid(a, b), sides[a] * sides[b]))
        strength[a, b] = float((_pair_tree(g, h) * g).sum())
    model.pairs = sorted(strength, key=lambda p: (-strength[p], p))[:PAIRS]
    model.pair_tables = [np.zeros((sides[a], sides[b])) for a, b in model.pairs]
    for _ in range(ROUNDS // 3):
        for (a, b), table in zip(model.pairs, model.pair_tables):
            place = grid(a, b)
            step = RATE * _pair_tree(*(s.reshape(table.shape) for s in sums(place, table.size)))
            table += step
            total += step.ravel()[place]
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; a null id counts as one."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = MAX_ROWS) -> Additive:
    """Learn ``label`` (0/1) from at most ``max_rows`` labelled rows."""
    usable = labels.where(~held_out(F.col(key)) & F.col(label).isin(0, 1)).select(
        F.col(key).alias("__id"), F.col(label).cast("double").alias("__y"))
    # Bounded by max_rows, so the broadcast is.
    chosen = usable.orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_rows)
    rows = small_batches(documents).select(F.col(key).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(chosen), "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch["__text"])
            for i, part, off in pieces(data, at):
                x = features(part, off)
                yield pa.RecordBatch.from_arrays(
                    [batch["__id"].slice(i, len(x)), batch["__y"].slice(i, len(x)), pa.array(x.tolist())],
                    names=["id", "y", "x"])

    schema = T.StructType([
        T.StructField("id", rows.schema["__id"].dataType), T.StructField("y", T.DoubleType()),
        T.StructField("x", T.ArrayType(T.DoubleType()))])
    # A repeated id brings one row per document of that id: bounded again.
    sample = rows.mapInArrow(run, schema).orderBy(F.xxhash64("id"), "id", "y", "x").limit(max_rows).collect()
    x = np.array([r["x"] for r in sample], dtype=np.float64).reshape(len(sample), len(FEATURES))
    return fit_rows(x, np.array([r["y"] for r in sample], dtype=np.float64))


def scored(documents: DataFrame, model: Additive, text: str = "text", score: str = "score") -> DataFrame:
    """``documents`` with ``score``; a column of that name is replaced."""
    base = documents.drop(score)
    schema = T.StructType([*base.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch[text])
            out = [model.score(features(part, off)) for _, part, off in pieces(data, at)]
            values = pa.array(np.concatenate(out) if out else np.empty(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=schema.names)

    return small_batches(base).mapInArrow(run, schema)


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and decision per document; only id and text are read."""
    model = fit(documents, labels)
    return scored(documents.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with their columns."""
    model = fit(documents, labels)
    return scored(documents, model, score="__score").where(F.col("__score") >= THRESHOLD).drop("__score")
