"""An FM-index over the word sequences of one shard, with a wavelet matrix for its ranks.

The wavelet matrix keeps one bit per word and level, in machine words with running counts;
no other copy of the shard's text is searched. Suffixes are sorted to ``depth`` words,
which is enough for patterns of that length: a backward step only needs rows to be in order
by the words matched so far.
"""

from __future__ import annotations

import numpy as np


class FMIndex:
    def __init__(self, symbols: np.ndarray, depth: int):
        """symbols: whole numbers from 0; 0 ends a sequence and is in no pattern."""
        n = len(symbols)
        self.size = int(symbols.max(initial=0)) + 1
        rank = symbols.astype(np.int64)
        span = 1
        while span < depth:
            ahead = np.r_[rank[span:] + 1, np.zeros(min(span, n), np.int64)]
            key = rank * (n + self.size + 1) + ahead
            order = np.argsort(key, kind="stable")
            change = np.diff(key[order], prepend=-1) != 0
            rank[order] = np.cumsum(change) - 1
            span *= 2
            if change.all():
                break
        self.suffixes = np.argsort(rank, kind="stable")
        counts = np.bincount(symbols, minlength=self.size)
        self.firsts = np.cumsum(counts) - counts
        self.lasts = np.cumsum(counts)
        self._wavelet(symbols[self.suffixes - 1], n)

    def _wavelet(self, row: np.ndarray, n: int) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        row = row.astype(np.int64)
        place = np.zeros(self.size, np.int64)
        every = np.arange(self.size)
        self.shifts = list(range(max(1, int(self.size - 1).bit_length()) - 1, -1, -1))
        for shift in self.shifts:
            bit = (row >> shift & 1).astype(bool)
            packed = np.packbits(np.r_[bit, np.zeros(-n % 64 + 64, bool)], bitorder="little").view(np.uint64)
            ones = np.bitwise_count(packed).astype(np.int64)
            level = (packed, np.cumsum(ones) - ones, n - int(bit.sum()))
            self.levels.append(level)
            place = self._step(level, (every >> shift & 1).astype(bool), place)
            row = np.r_[row[~bit], row[bit]]
        self.place = place

    @staticmethod
    def _step(level: tuple, bit: np.ndarray, at: np.ndarray) -> np.ndarray:
        packed, counts, zeros = level
        word = at >> 6
        below = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        ones = counts[word] + np.bitwise_count(below)
        return np.where(bit, zeros + ones, at - ones)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands in the transform before each place."""
        for shift, level in zip(self.shifts, self.levels, strict=True):
            at = self._step(level, (symbol >> shift & 1).astype(bool), at)
        return at - self.place[symbol]

    def search(self, symbols: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
        """Backward search for the patterns symbols[end - length : end] of the given ends.

        Returns (which, low, high) for those that more than one suffix starts with.
        """
        which = np.arange(len(ends))
        last = symbols[ends - 1]
        low, high = self.firsts[last], self.lasts[last]
        for step in range(2, length + 1):
            live = high - low > 1
            which, low, high = which[live], low[live], high[live]
            if not len(which):
                break
            symbol = symbols[ends[which] - step]
            both = self.rank(np.r_[symbol, symbol], np.r_[low, high]) + self.firsts[np.r_[symbol, symbol]]
            low, high = both[: len(which)], both[len(which) :]
        live = high - low > 1
        return which[live], low[live], high[live]
