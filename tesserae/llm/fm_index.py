"""A compressed FM-index over sequences of integers: backward search over a wavelet matrix, for many patterns at once."""

from __future__ import annotations

import numpy as np


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes, sorted by their first `depth` symbols or more (prefix doubling); ties by place.

    Backward search needs no deeper order: suffixes that share the pattern's next part stand together.
    """
    n = len(symbols)
    rank = symbols.astype(np.int64)
    step = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - step] = rank[step:] + 1
        key = rank * (int(second.max(initial=0)) + 1) + second if step < depth else rank
        order = np.argsort(key, kind="stable")
        if step >= depth:
            return order
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(False, sorted_key[1:] != sorted_key[:-1]))
        step *= 2


class Wavelet:
    """Wavelet matrix: one bit vector a level, packed in 64-bit words with the count of ones before each word."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.n, self.levels = len(symbols), max(1, int(sigma - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        now = symbols.astype(np.int64)
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.append(packed, np.zeros(8 + -len(packed) % 8, np.uint8)).view(np.uint64)
            self.words.append(packed)
            self.before.append(np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]).astype(np.uint32))
            self.zeros.append(self.n - int(bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word].astype(np.int64) + np.bitwise_count(self.words[level][word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before the given place."""
        low = np.zeros_like(at)
        for i, level in enumerate(range(self.levels - 1, -1, -1)):
            ones_low, ones_at = self._ones(i, low), self._ones(i, at)
            bit = (symbol >> level & 1).astype(bool)
            low = np.where(bit, self.zeros[i] + ones_low, low - ones_low)
            at = np.where(bit, self.zeros[i] + ones_at, at - ones_at)
        return at - low


class FMIndex:
    """Finds patterns of up to `depth` symbols, and matching statistics. Symbols are 0 .. sigma - 1; 0 ends every sequence and occurs in no pattern."""

    def __init__(self, symbols: np.ndarray, sigma: int, depth: int):
        if len(symbols) and symbols[-1]:
            raise ValueError("the last symbol must be 0")
        self.n = len(symbols)
        self.order = suffix_order(symbols, depth)
        self.first = np.append(0, np.cumsum(np.bincount(symbols, minlength=sigma))).astype(np.int64)
        # before the first symbol stands the last one, a 0, which no pattern looks for
        self.wavelet = Wavelet(symbols[self.order - 1], sigma)

    def matching(self, symbols: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [low, high) of the patterns symbols[start : start + length], all searched backward together."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n, np.int64)
        for back in range(length - 1, -1, -1):
            s = symbols[starts + back]
            low = self.first[s] + self.wavelet.rank(s, low)
            high = self.first[s] + self.wavelet.rank(s, high)
        return low, high

    def statistics(self, symbols: np.ndarray, ends: np.ndarray, most: np.ndarray, least: "RangeMinimum | None" = None, below: np.ndarray | None = None) -> np.ndarray:
        """Matching statistics: the longest suffix, up to `most` symbols, of what stands before each end that occurs in
        the index; with `least`, that occurs at a suffix whose value is less than the end's in `below`."""
        low, high, length = np.zeros(len(ends), np.int64), np.full(len(ends), self.n, np.int64), np.zeros(len(ends), np.int64)
        live = np.arange(len(ends))
        for back in range(1, int(most.max(initial=0)) + 1):
            live = live[most[live] >= back]
            s = symbols[ends[live] - back]
            ok = s > 0
            live, s = live[ok], s[ok]
            a, b = self.first[s] + self.wavelet.rank(s, low[live]), self.first[s] + self.wavelet.rank(s, high[live])
            ok = a < b
            if least is not None:
                ok[ok] = least(a[ok], b[ok]) < below[live[ok]]
            live = live[ok]
            low[live], high[live] = a[ok], b[ok]
            length[live] = back
        return length


class RangeMinimum:
    """The least of values[low:high] for each of many non-empty ranges: a sparse table."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while len(self.tables[-1]) > (half := 1 << len(self.tables) - 1):
            self.tables.append(np.minimum(self.tables[-1][:-half], self.tables[-1][half:]))

    def __call__(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), self.tables[0].dtype)
        for k in np.unique(level).tolist():
            here = np.flatnonzero(level == k)
            out[here] = np.minimum(self.tables[k][low[here]], self.tables[k][high[here] - (1 << k)])
        return out
