"""Token counts of whole texts without materialising ids.

A byte-level BPE never merges across pre-tokens, so the count of a text is the
sum over its pre-tokens of how many pieces each has. Pieces are counted once per
distinct pre-token of the corpus and joined to the pre-token frequencies of the
documents.

Pre-token frequencies are as skewed as words are, so the join has two parts. The
most frequent pre-tokens (at most ``HOT`` of at most ``HOT_BYTES`` bytes each:
a bounded table) are broadcast and summed where the text is read. All others,
which no document group can make hot in number of rows beyond the least frequent
broadcast one, are joined by a shuffle of (document row, pre-token, frequency).

Null and empty texts have no tokens. Special strings inside a text (the added
tokens of the file) count as one token each, as the library has it by default.
Repeated or null ids are rows of their own; columns other than the kept ones are
ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from fleethealth.llm.store import staged
from fleethealth.llm.text import pieces, text_bytes
from fleethealth.llm.tokens import _byte_letters

HOT, HOT_BYTES = 100_000, 256
CHUNK = 1 << 22

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
_KIND = {"L": LETTER, "N": NUMBER}


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """Kind of every code point. Unassigned ones are UNKNOWN: the library may
    know a later edition of the character tables than Python does."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        name = unicodedata.category(chr(c))
        if name == "Cn":
            out[c] = UNKNOWN
        elif name[0] in _KIND:
            out[c] = _KIND[name[0]]
        elif chr(c).isspace() and not 0x1C <= c <= 0x1F:
            out[c] = SPACE
    return out


def starts(code: np.ndarray, kind: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Which code points begin a pre-token. ``edge`` marks those that begin a text.

    Runs of one kind stay together and take a single space before them; of other
    white space before a word the last character is apart; an apostrophe that
    begins a pre-token and s, t, m, d, re, ve or ll are one.
    """
    n = len(code)
    before, after = np.empty(n, np.uint8), np.empty(n, np.uint8)
    before[1:], after[:-1] = kind[:-1], kind[1:]
    last = np.empty(n, bool)
    last[:-1], last[-1] = edge[1:], True
    space = kind == SPACE
    after_space = np.zeros(n, bool)
    after_space[1:] = space[:-1]
    blank = np.zeros(n, bool)
    blank[1:] = code[:-1] == 0x20
    ends_run = space & ~last
    ends_run[:-1] &= kind[1:] != SPACE
    begin = np.where(space, ~after_space | ends_run, np.where(after_space, ~blank, before != kind))
    begin |= edge
    quote = np.flatnonzero(begin & (code == 0x27) & ~last)
    if len(quote):
        # Padding keeps the look-ahead inside the array; a text's end stops it.
        ahead, own = np.concatenate([code, [0, 0]]), np.concatenate([edge, [True, True]])
        one, two = ahead[quote + 1], np.where(own[quote + 2], 0, ahead[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        ends = np.concatenate([quote[short] + 2, quote[long] + 3])
        begin[quote[short | long] + 1] = False
        begin[ends[ends < n]] = True
    return begin


class PreTokens:
    """Pre-tokens of a byte-level tokenizer file, and how many pieces one has."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        cut = self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder().values()
        plain = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in added)
        if self.tokenizer.normalizer is not None or type(cut).__name__ != "ByteLevel" or cut.add_prefix_space or not plain:
            raise ValueError("not a plain byte-level tokenizer: " + path)
        self.letters = _byte_letters()
        self.bytes_of = {ord(v): k for k, v in self.letters.items()}
        special = sorted((t.content for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def size(self, piece: str) -> int:
        mapped = "".join(map(self.letters.__getitem__, piece.encode()))
        return len(self.tokenizer.model.tokenize(mapped))

    def of_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def of(self, data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(pre-tokens of all texts in order, index of each text's first with one
        more entry, special strings per text)."""
        n, special = len(at) - 1, np.zeros(len(at) - 1, np.int64)
        raw = data.tobytes()
        owner = np.arange(n)
        if self.special is not None and self.special.search(text := raw.decode()):
            # A text with special strings becomes the parts between them.
            parts, owners = [], []
            for i in range(n):
                own = self.special.split(raw[at[i]:at[i + 1]].decode())
                special[i] = len(own) - 1
                parts += own
                owners += [i] * len(own)
            data, at = text_bytes(pa.array(parts, pa.large_string()))
            raw, owner = data.tobytes(), np.array(owners)
        code = np.frombuffer(raw.decode().encode("utf-32-le"), "<u4")
        place = np.flatnonzero((data & 0xC0) != 0x80)
        kind = kinds()[code]
        first = np.searchsorted(place, at)  # of each part, in code points
        edge = np.zeros(len(code), bool)
        edge[first[:-1][first[:-1] < first[1:]]] = True
        begin = starts(code, kind, edge) if len(code) else edge
        unknown = np.unique(np.searchsorted(first, np.flatnonzero(kind == UNKNOWN), "right") - 1)
        for i in unknown.tolist():
            begin[first[i]:first[i + 1]] = False
            at_code = first[i]
            for piece in self.of_library(raw[at[i]:at[i + 1]].decode()):
                begin[at_code] = True
                at_code += len(piece)
        cuts = np.append(place[begin], len(data)).astype(np.int32)
        found = pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data))
        # Parts of one text are neighbours, so a text's first is that of its first part.
        of_part = np.searchsorted(cuts[:-1], at)
        starts_at = np.searchsorted(owner, np.arange(n + 1))
        return found, of_part[starts_at], special


@lru_cache(maxsize=1)
def pre_tokens(path: str) -> PreTokens:
    """One per worker process."""
    return PreTokens(path)


def frequencies(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(piece, n): occurrences of every distinct pre-token, summed before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, at in pieces(*text_bytes(batch.column(0)), CHUNK):
                found = pre_tokens(path).of(data, at)[0].dictionary_encode()
                n = np.bincount(found.indices.to_numpy(zero_copy_only=False), minlength=len(found.dictionary))
                yield pa.RecordBatch.from_arrays([found.dictionary, pa.array(n.astype(np.int64))], names=["piece", "n"])

    return docs.select(text).mapInArrow(run, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))


def piece_sizes(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """(piece, n, size): each distinct pre-token tokenized once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [pre_tokens(path).size(p) for p in batch.column("piece").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(size, pa.int64())], names=["piece", "n", "size"])

    return frequencies(docs, path, text).mapInArrow(run, "piece string, n long, size long")


def token_counts(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",), text: str = "text",
                 hot: int = HOT) -> DataFrame:
    """Columns ``keep`` and n_bytes, n_tokens of every row of ``docs``."""
    spark = docs.sparkSession
    sizes = staged(piece_sizes(docs, path, text), "pre-tokens")
    frequent = (sizes.where(F.octet_length("piece") <= HOT_BYTES).orderBy(F.desc("n"), "piece").limit(hot)
                .select("piece", "size").toArrow())
    table = spark.sparkContext.broadcast((frequent["piece"].combine_chunks(), frequent["size"].to_numpy()))
    keep = list(keep)
    source = docs.select(*keep, F.col(text).alias("__text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in source.dtypes[:-1])
    item = pa.struct([("piece", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = table.value
        for batch in batches:
            for row, data, at in pieces(*text_bytes(batch.column(len(keep))), CHUNK):
                n = len(at) - 1
                found, first, special = pre_tokens(path).of(data, at)
                coded = found.dictionary_encode()
                place = pc.index_in(coded.dictionary, value_set=known).fill_null(-1).to_numpy()
                own = np.append(size, 0)[place]
                code = coded.indices.to_numpy(zero_copy_only=False)
                total = np.append(0, np.cumsum(own[code]))
                # Frequencies of the other pre-tokens, per document.
                rest = np.flatnonzero(place[code] < 0)
                doc = np.searchsorted(first, rest, "right") - 1
                pairs, many = np.unique(doc * len(place) + code[rest], return_counts=True)
                ends = np.searchsorted(pairs, np.arange(n + 1) * len(place)).astype(np.int32)
                words = coded.dictionary.take(pa.array(pairs % max(1, len(place))))
                tail = pa.StructArray.from_arrays([words, pa.array(many.astype(np.int64))], fields=list(item))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(row, n) for i in range(len(keep))), pa.array(np.diff(at)),
                     pa.array(total[first[1:]] - total[first[:-1]] + special),
                     pa.ListArray.from_arrays(pa.array(ends), tail)],
                    names=[*keep, "__bytes", "__known", "__rest"])

    rows = staged(
        source.mapInArrow(run, f"{fields}{', ' if fields else ''}__bytes long, __known long, "
                               "__rest array<struct<piece: string, n: long>>")
        .withColumn("__row", F.monotonically_increasing_id()), "token-counts")
    others = rows.select("__row", F.explode("__rest").alias("f")).select("__row", "f.*").join(
        sizes.select("piece", "size"), "piece").groupBy("__row").agg(F.sum(F.col("n") * F.col("size")).alias("__others"))
    return rows.join(others, "__row", "left").select(
        *keep, F.col("__bytes").alias("n_bytes"),
        (F.col("__known") + F.coalesce("__others", F.lit(0))).alias("n_tokens"))


def digest(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether a document is longer than ``limit``."""
    return token_counts(docs, path).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
