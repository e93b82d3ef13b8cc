"""An FM-index over a sequence of word numbers, with all searches done on arrays of patterns."""

from __future__ import annotations

import numpy as np

SAMPLED = 16


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling. The last symbol must be the least, and
    stand nowhere else."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, step = len(text), 1
    while True:
        pair = rank * (n + 1)
        pair[: n - step] += rank[step:] + 1
        order = np.argsort(pair, kind="stable")
        ordered = pair[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank, step = new, step * 2
        if step >= n or rank[order[-1]] == n - 1:
            return order


class WaveletMatrix:
    """Counts of any symbol in any prefix of a sequence."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros, self.starts = [], [], None
        left = symbols
        for level in reversed(range(self.bits)):
            bit = (left >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))).astype(np.int32))
            self.zeros.append(len(left) - int(self.ones[-1][-1]))
            left = np.concatenate((left[bit == 0], left[bit == 1]))
        # where each symbol's run starts in the last level
        self.starts = np.searchsorted(_reversed_bits(left, self.bits),
                                      _reversed_bits(np.arange(alphabet), self.bits))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        at = end
        for n, level in enumerate(reversed(range(self.bits))):
            ones = self.ones[n][at]
            at = np.where((symbol >> level) & 1, self.zeros[n] + ones, at - ones)
        return at - self.starts[symbol]


def _reversed_bits(values: np.ndarray, bits: int) -> np.ndarray:
    """The order in which the last level of a wavelet matrix holds the symbols."""
    out = np.zeros_like(values)
    for _ in range(bits):
        out, values = (out << 1) | (values & 1), values >> 1
    return out


class FMIndex:
    """Backward search and location in ``text``; symbol 0 must stand at its end alone."""

    def __init__(self, text: np.ndarray, alphabet: int):
        order = suffix_array(text)
        self.last = text[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=alphabet))))
        self.ranks = WaveletMatrix(self.last, alphabet)
        sampled = order % SAMPLED == 0
        self.sampled = sampled
        self.sample_of = np.cumsum(sampled) - 1
        self.samples = order[sampled]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of patterns of one length: (pattern, first row, row after the last) where any."""
        which = np.arange(len(patterns))
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.last), np.int64)
        for column in reversed(range(patterns.shape[1])):
            symbol = patterns[which, column]
            low = self.before[symbol] + self.ranks.rank(symbol, low)
            high = self.before[symbol] + self.ranks.rank(symbol, high)
            alive = low < high
            which, low, high = which[alive], low[alive], high[alive]
        return which, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes in these rows: steps back to a sampled place."""
        place = np.zeros(len(rows), np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            done = self.sampled[at]
            place[open_[done]] = self.samples[self.sample_of[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            symbol = self.last[at]
            at = self.before[symbol] + self.ranks.rank(symbol, at)
            steps += 1
        return place
