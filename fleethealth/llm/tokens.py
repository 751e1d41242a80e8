"""Token ids of whole texts with a word-wise tokenizer, cached by word.

The tokenizer drops white space and never joins across it, so a text's ids are
those of its words in order. Ids of words seen before come from a dictionary;
words that are one run of letters and trailing punctuation are cached by their
lower-case letters, which are shared by many spellings.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Entries kept per worker process; a full cache starts anew.
MAX_WORDS, MAX_CORES = 300_000, 400_000

_SPELLING = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.;:!?$%&*#|]*)")


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Cores(dict):
    def __init__(self, tokenizer: Tokenizer) -> None:
        self.model, self.letters = tokenizer.model, _byte_letters()

    def __missing__(self, core: str) -> bytes:
        if len(self) >= MAX_CORES:
            self.clear()
        mapped = core if core.isascii() else "".join(map(self.letters.__getitem__, core.encode()))
        ids = np.array([t.id for t in self.model.tokenize(mapped)], dtype="<u4").tobytes() if core else b""
        self[core] = ids
        return ids


class _Words(dict):
    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer, self.cores = tokenizer, _Cores(tokenizer)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MAX_WORDS:
            self.clear()
        text = word.decode()
        if m := _SPELLING.fullmatch(text):
            ids = self.cores[m[1].lower()] + self.cores[m[2]]
        else:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        self[word] = ids
        return ids


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        self.words = _Words(Tokenizer.from_file(path))

    def encode(self, text: str | None) -> bytes:
        # bytes.split() parts at 0x20 and 0x09-0x0D only, all white space for the tokenizer.
        return b"".join(map(self.words.__getitem__, text.encode().split())) if text else b""


@lru_cache(maxsize=1)
def tokenizer(path: str) -> WordTokenizer:
    """One per worker process."""
    return WordTokenizer(path)


def id_lists(encoded: list[bytes]) -> pa.Array:
    """A list<int32> array of encoded texts."""
    ends = np.cumsum([0, *(len(x) // 4 for x in encoded)])
    if ends[-1] >= 1 << 31:
        raise ValueError("too many ids for one batch; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    ids = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"), pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)
