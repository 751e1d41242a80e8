"""FM-index of a shard of word sequences, searched for many patterns at once.

The sequences end in separators that are all different, so their suffixes have
one order. The Burrows-Wheeler transform is held in a wavelet matrix whose bit
rows are packed, with counts per 64 bits. Patterns are searched backward, all
active ones in one array operation per step. Each suffix carries the rank of its
sequence's owner; a sparse table gives the smallest owner of a suffix range.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_ONE = U64(1)


class Bits:
    """Packed bits with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 2, dtype=U64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        word = i >> 6
        mask = (_ONE << (i & 63).astype(U64)) - _ONE
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class Wavelet:
    """Wavelet matrix of small non-negative numbers."""

    def __init__(self, values: np.ndarray, kinds: int) -> None:
        self.levels = max(1, int(kinds - 1).bit_length())
        self.rows, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level) & 1 == 1
            self.rows.append(Bits(bit))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])
        every = np.arange(kinds)
        self.start = self._down(every, np.zeros(kinds, dtype=np.int64))

    def _down(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            ones = row.rank(i)
            i = np.where((value >> (self.levels - 1 - level)) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each value among the first ``i`` entries."""
        return self._down(value, i) - self.start[value]


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order by prefix doubling; ``depth`` symbols tell all apart."""
    n, rank, step = len(text), text.astype(np.int64), 1
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[:n - step] = rank[step:] + 1
        pair = rank * (n + 2) + ahead if step > 1 else rank * (int(rank.max(initial=0)) + 2) + ahead
        order = np.argsort(pair, kind="stable")
        fresh = np.empty(n, dtype=np.int64)
        run = pair[order]
        fresh[order] = np.cumsum(np.append(0, run[1:] != run[:-1]))
        rank, step = fresh, step * 2
        if step >= depth or (n and rank.max() == n - 1):
            return order


class FMIndex:
    """Index of sequences given as one array of symbols (0 to kinds-1) and
    offsets; ``owner`` is a number per sequence."""

    def __init__(self, symbols: np.ndarray, at: np.ndarray, owner: np.ndarray, kinds: int) -> None:
        many = len(at) - 1
        size = np.diff(at)
        self.base = at[:-1] + np.arange(many)
        text = np.empty(len(symbols) + many, dtype=np.int64)
        ends = self.base + size
        inside = np.ones(len(text), dtype=bool)
        inside[ends] = False
        text[inside] = symbols + many
        text[ends] = np.arange(many)
        order = suffix_order(text, int(size.max(initial=0)) + 1)
        # Separators are never searched; in the transform they are all 0.
        self.text = np.where(inside, text - many + 1, 0)
        self.first = np.concatenate([[0, many], many + np.cumsum(np.bincount(symbols, minlength=kinds))])
        self.wavelet = Wavelet(self.text[order - 1], kinds + 1)
        self.n = len(text)
        row = np.repeat(owner, size + 1)[order].astype(np.int32)
        self.least = [row]
        while len(self.least[-1]) > 1 and (1 << len(self.least)) <= self.n:
            half = 1 << (len(self.least) - 1)
            self.least.append(np.minimum(self.least[-1][:-half], self.least[-1][half:]))

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of each pattern with ``symbol`` put before it."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        begin = self.first[symbol]
        return begin + both[:len(symbol)], begin + both[len(symbol):]

    def smallest_owner(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest owner in each non-empty range."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.least[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return out

    def matches(self, owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of every indexed sequence against those of smaller
        owners: (sequence, begin, end) of the maximal matches of ``window`` or
        more symbols.

        From an end e a match is extended backward until it fails at f. No window
        that holds f and e-1 can match then, and windows behind f are settled, so
        the next end is at most f + window. A short probe from f + 4 tells first
        whether anything over f can match at all.
        """
        size = np.diff(np.append(self.base, self.n)) - 1
        live = np.flatnonzero(size >= window)
        end = size[live].copy()
        at, low, high = end.copy(), np.zeros(len(live), np.int64), np.full(len(live), self.n)
        probe = np.full(len(live), -1)  # the f under probe
        later = np.zeros(len(live), np.int64)  # the end to go on with if the probe passes
        tried = np.full(len(live), -1)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(live):
            symbol = self.text[self.base[live] + at - 1]
            lo, hi = self.step(symbol, low, high)
            ok = lo < hi
            if ok.any():
                some = np.flatnonzero(ok)
                ok[some] = self.smallest_owner(lo[some], hi[some]) < owner[live[some]]
            at = at - ok
            low, high = np.where(ok, lo, low), np.where(ok, hi, high)
            probing = probe >= 0
            passed = probing & ok & (at == probe)
            failed_probe = probing & ~ok
            stop = ~probing & (~ok | (at == 0))
            hit = np.flatnonzero(stop & (end - at >= window))
            if len(hit):
                found.append((live[hit], at[hit], end[hit]))
            done = stop & (at == 0)
            fail = at - 1
            plan = np.minimum(end - 1, fail + window)
            short = stop & ~done & (fail + 4 < plan) & (tried != fail)
            tried = np.where(short, fail, tried)
            new_end = np.where(passed, later, np.where(failed_probe, probe + 3, np.where(short, fail + 4, plan)))
            later = np.where(short, plan, later)
            restart = (stop & ~done) | passed | failed_probe
            probe = np.where(short, fail, np.where(restart, -1, probe))
            end = np.where(restart, new_end, end)
            at = np.where(restart, end, at)
            low, high = np.where(restart, 0, low), np.where(restart, self.n, high)
            keep = ~done & (np.where(probe >= 0, later, end) >= window)
            if not keep.all():
                live, end, at, low, high, probe, later, tried = (
                    x[keep] for x in (live, end, at, low, high, probe, later, tried))
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*found))
