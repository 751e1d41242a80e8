"""Words and shingles of texts as hash arrays, straight from Arrow buffers.

Words are runs of bytes other than space and 0x09-0x0D. All functions take the
bytes of many texts at once; a text is the slice between two offsets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_STEP = U64(0xD1342543DE82EF95)
CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; a bijection."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.full(n, _BASE, dtype=U64)
    back = np.full(n, pow(_BASE, -1, 1 << 64), dtype=U64)
    base[0] = back[0] = 1
    return np.cumprod(base), np.cumprod(back)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def pieces(data: np.ndarray, at: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, bytes, offsets) of runs of whole texts of about ``limit`` bytes."""
    first, n = 0, len(at) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


class Words:
    """Word places and hashes of a run of texts.

    ``begin``/``end``: byte places; ``first``: index of each text's first word,
    one more entry than texts; ``code``: 64-bit hash of each word's bytes.
    """

    def __init__(self, data: np.ndarray, at: np.ndarray, lower: bool = False) -> None:
        if lower:
            data = _LOWER[data]
        n = len(data)
        self.data = data
        gap = _SPACE[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[at] = True
        before = np.ones(n, dtype=bool)
        before[1:] = gap[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = gap[1:]
        self.begin = np.flatnonzero(~gap & (before | edge[:n]))
        self.end = np.flatnonzero(~gap & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.begin, at)
        size = 1 << max(int(n).bit_length(), 20)
        power, back = _powers(size)
        run = np.zeros(n + 1, dtype=U64)
        np.cumsum((data.astype(U64) + U64(1)) * power[:n], out=run[1:])
        self.code = mix((run[self.end] - run[self.begin]) * back[self.begin] + (self.end - self.begin).astype(U64))


def rolled(code: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (texts are not told apart)."""
    n = len(code) - k + 1
    if n <= 0:
        return np.empty(0, dtype=U64)
    out = code[:n].copy()
    for j in range(1, k):
        out *= _STEP
        out += code[j:j + n]
    return mix(out + U64(k))


def shingle_sets(words: Words, k: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``k``-word shingles; a text of
    fewer words has its whole sequence as one, a text without words none."""
    runs = rolled(words.code, k)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        if n >= k:
            out.append(np.unique(runs[a:b - k + 1]))
        elif n:
            out.append(rolled(words.code[a:b], n))
        else:
            out.append(np.empty(0, dtype=U64))
    return out
