"""N-best SentencePiece segmentation and decoding.

A text, normalised by the model file, is a lattice whose edges are the pieces;
a segmentation's score is the sum of its pieces' scores. A forward Viterbi pass
gives the best score of every prefix. These are exact heuristics for an A-star
search that runs backward from the end, so segmentations come out best first
and no hypothesis off the N best is finished.

No piece has the space mark behind another character or holds a line feed and
more, so a path passes every place where a run of space marks begins and both
sides of a line feed, and the lattice falls apart there into chunks (and further,
between two characters that no piece has side by side) (a model without that property
makes one chunk). The best of a chunk and what its second best loses are cached. The
forward pass alone gives both: seen from the end, a second best leaves the best path
once, for the runner-up of that place. The N best of a text differ from its best one
only in the N-1 chunks that lose least by their second choice; these are searched,
and a heap combines their choices.

Characters without a piece become bytes at a penalty. Equal scores keep the
order of the search, which depends on the text alone. Null text is empty: one
segmentation without pieces, of score 0.
"""

from __future__ import annotations

import gc
import heapq
import re
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T

from fleethealth.llm.store import small_batches

MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Chunks kept per worker process, in two generations.
MAX_CHUNKS = 1_000_000
#: Chunks of up to so many characters whose N best are kept per worker process, and how many.
KEPT_CHARS, KEPT_SEARCHES = 100, 10_000
_CHUNKS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class _Chunks(dict):
    """(ids, score, loss of the second best) by chunk; two generations, so that
    frequent chunks outlive a full cache."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.old = model, {}

    def __missing__(self, s: str) -> tuple[bytes, float, float]:
        found = self.old.get(s)
        if found is None:
            parts = self.model.parted(s)
            if len(parts) > 1:
                of = [self[p] for p in parts]
                found = (b"".join([f[0] for f in of]), sum([f[1] for f in of]), min([f[2] for f in of]))
            else:
                found = self.model.best_and_loss(s)
        if len(self) >= MAX_CHUNKS // 2:
            self.old = dict(self)
            self.clear()
        self[s] = found
        return found


class PieceModel:
    """Pieces and scores of a model file."""

    def __init__(self, path: str) -> None:
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        plain = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i))]
        self.pieces = {sp.id_to_piece(i): (sp.get_score(i), i.to_bytes(4, "little")) for i in plain}
        # Every beginning of a piece, character by character: [score, ids, longer ones by their next
        # character]; the score is None where it is not a piece itself.
        self.begun: dict[str, list] = {}
        for p, (score, ids) in self.pieces.items():
            longer = self.begun
            for c in p:
                node = longer.setdefault(c, [None, b"", {}])
                longer = node[2]
            node[:2] = score, ids
        self.longest = max(map(len, self.pieces), default=0)
        worded = (s for p, (s, _) in self.pieces.items() if p.strip(MARK))
        self.unknown = min(worded, default=0.0) - UNKNOWN_PENALTY
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in every if sp.is_byte(i)}
        self.apart = not any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p) for p in self.pieces)
        self.unk = sp.unk_id()
        known = set(plain)
        self.spelled = [sp.id_to_piece(i).encode() if i in known else b"" for i in every]
        for value, i in self.bytes.items():
            self.spelled[i] = bytes([value])
        # Two characters that stand together in no piece: every path parts between them.
        self.inside = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        self.cache = _Chunks(self)
        self.searches = lru_cache(KEPT_SEARCHES)(self.best_of_chunk)

    def parted(self, s: str) -> list[str]:
        """``s`` cut wherever no piece can cross."""
        inside, out, last = self.inside, [], 0
        for i in range(1, len(s)):
            if s[i - 1:i + 1] not in inside:
                out.append(s[last:i])
                last = i
        out.append(s[last:])
        return out

    def spelling(self, c: str) -> bytes:
        """Ids of a character without a piece."""
        return np.array([self.bytes.get(b, self.unk) for b in c.encode()], dtype="<u4").tobytes()

    def lattice(self, s: str) -> tuple[list[list[tuple[int, float, bytes]]], list[float]]:
        """Per end place the (begin, score, ids) of the pieces that end there, and
        the best score of every prefix (Viterbi: a place is settled before its
        own edges are followed)."""
        n = len(s)
        into: list[list[tuple[int, float, bytes]]] = [[] for _ in range(n + 1)]
        forward = [-float("inf")] * n + [-float("inf") if n else 0.0]
        forward[0] = 0.0
        for i in range(n):
            here = forward[i]
            if s[i] not in self.pieces:
                into[i + 1].append((i, self.unknown, self.spelling(s[i])))
                forward[i + 1] = max(forward[i + 1], here + self.unknown)
            j, longer = i, self.begun
            for c in s[i:i + self.longest]:
                node = longer.get(c)
                if node is None:
                    break
                j += 1
                score, ids, longer = node
                if score is not None:
                    into[j].append((i, score, ids))
                    if here + score > forward[j]:
                        forward[j] = here + score
        return into, forward

    def best_and_loss(self, s: str) -> tuple[bytes, float, float]:
        """Ids and score of the best of one lattice, and what the second best loses.

        Of equal scores the longest last piece wins, as in the search for the n best.
        """
        n, least, pieces, unknown = len(s), -float("inf"), self.pieces, self.unknown
        best, runner_up, begin, last = [least] * (n + 1), [least] * (n + 1), [0] * (n + 1), [b""] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here = best[i]
            if s[i] not in pieces:
                j, total = i + 1, here + unknown
                if total > best[j]:
                    runner_up[j], best[j], begin[j], last[j] = best[j], total, i, self.spelling(s[i])
                elif total > runner_up[j]:
                    runner_up[j] = total
            j, longer = i, self.begun
            for c in s[i:i + self.longest]:
                node = longer.get(c)
                if node is None:
                    break
                j += 1
                score, ids, longer = node
                if score is not None:
                    total = here + score
                    if total > best[j]:
                        runner_up[j], best[j], begin[j], last[j] = best[j], total, i, ids
                    elif total > runner_up[j]:
                        runner_up[j] = total
        loss, out, j = float("inf"), [], n
        while j:
            loss = min(loss, best[j] - runner_up[j])
            out.append(last[j])
            j = begin[j]
        return b"".join(out[::-1]), best[n], loss

    def best_of_chunk(self, s: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best (score, ids) of one lattice, best first."""
        into, forward = self.lattice(s)
        out: list[tuple[float, bytes]] = []
        # (-(score so far + best of the rest), place, order of entry, score so far, ids of the end or None, hypothesis behind)
        heap = [(-forward[-1], len(s), 0, 0.0, b"", None)]
        taken = [0] * (len(s) + 1)
        entry = 1
        push, pop = heapq.heappush, heapq.heappop
        while heap and len(out) < n:
            top = pop(heap)
            _, at, _, score, _, _ = top
            if not at:
                parts = []
                while top is not None:
                    parts.append(top[4])
                    top = top[5]
                out.append((score, b"".join(parts)))
                continue
            # The n best never need more than n ends from one place.
            if taken[at] >= n:
                continue
            taken[at] += 1
            for i, s_, piece in into[at]:
                if taken[i] < n:
                    so_far = score + s_
                    push(heap, (-(so_far + forward[i]), i, entry, so_far, piece, top))
                    entry += 1
        return out

    def chunks(self, text: str) -> list[str]:
        s = self.sp.normalize(text)
        return (_CHUNKS.findall(s) if self.apart else [s]) if s else []

    def segmentations(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best (score, ids) of a whole text, best first."""
        chunks = self.chunks(text)
        found = list(map(self.cache.__getitem__, chunks))
        best = [f[0] for f in found]
        total = sum([f[1] for f in found])
        out = [(total, b"".join(best))]
        if n == 1:
            return out
        loss = np.array([f[2] for f in found])
        order = np.argsort(loss, kind="stable")[:n - 1]
        place = [int(i) for i in order if np.isfinite(loss[i])]
        choices = [
            (self.searches if len(chunks[i]) <= KEPT_CHARS else self.best_of_chunk)(chunks[i], n) for i in place]
        lost = lambda k, c: choices[k][0][0] - choices[k][c][0]
        # A state is the choice of each of these chunks; (loss, chunk last raised, choices).
        heap = [(lost(k, 1), k, (0,) * k + (1,) + (0,) * (len(place) - k - 1)) for k in range(len(place))]
        heapq.heapify(heap)
        while heap and len(out) < n:
            down, k, state = heapq.heappop(heap)
            alternative = best.copy()
            for i, options, c in zip(place, choices, state):
                alternative[i] = options[c][1]
            out.append((total - down, b"".join(alternative)))
            # Raise this chunk further, or begin on a later one: every state is reached once.
            for m in range(k, len(place)):
                c = state[m] + 1
                if c < len(choices[m]):
                    more = down - lost(m, state[m]) + lost(m, c)
                    heapq.heappush(heap, (more, m, (*state[:m], c, *state[m + 1:])))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids: pieces joined, bytes restored, space marks turned back."""
        values = array("I")
        values.frombytes(ids)
        text = b"".join(map(self.spelled.__getitem__, values)).decode(errors="replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def piece_model(path: str) -> PieceModel:
    """One per worker process."""
    return PieceModel(path)


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for reference cycles: a segmentation makes many tuples, none of them in a cycle."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


SEGMENTED = T.ArrayType(T.StructType([
    T.StructField("score", T.DoubleType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def encoded(df: DataFrame, path: str, n: int, text: str = "text", column: str = "segmentations") -> DataFrame:
    """``df`` with the ``n`` best segmentations of each text; a column of that name is replaced."""
    base = df.drop(column)
    schema = T.StructType([*base.schema.fields, T.StructField(column, SEGMENTED)])
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                with uncollected():
                    rows = [
                        [{"score": s, "ids": np.frombuffer(ids, dtype="<i4")} for s, ids in model.segmentations(t or "", n)]
                        for t in batch[text].slice(i, 100).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(i, 100) for c in batch.columns), pa.array(rows, kind)], names=schema.names)

    return small_batches(base).mapInArrow(run, schema)


def decoded(df: DataFrame, path: str, ids: str = "ids", column: str = "text") -> DataFrame:
    """``df`` with the text of each id list; null ids give null."""
    @F.pandas_udf("string")
    def run(lists):
        model = piece_model(path)
        return lists.map(lambda x: None if x is None else model.decode(np.asarray(x, dtype="<u4").tobytes()))

    return df.withColumn(column, run(F.col(ids)))


def digest(documents: DataFrame, path: str, n: int = 4) -> DataFrame:
    """Scores and id checksums of the ``n`` best of each text, and whether the
    best one decodes to the text again."""
    schema = ("doc_id long, n_pieces long, ids_crc32 long, scores array<double>, alternative_crc32 array<long>, "
              "decoded_crc32 long, round_trip boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for batch in batches:
            rows = []
            with uncollected():
                for text in batch["text"].to_pylist():
                    text = text or ""
                    found = model.segmentations(text, n)
                    back = model.decode(found[0][1])
                    rows.append((
                        len(found[0][1]) // 4, zlib.crc32(found[0][1]), [s for s, _ in found],
                        [zlib.crc32(ids) for _, ids in found[1:]], zlib.crc32(back.encode()), back == text))
            cols = list(zip(*rows)) or [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_pieces", "ids_crc32", "scores", "alternative_crc32", "decoded_crc32", "round_trip"])

    return small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
