"""Context-tree weighting over bytes, decomposed into binary decisions.

A byte is eight decisions; a decision is known by the bits before it in the byte. Each has its own
tree of contexts, the 0 to ``DEPTH`` bytes before, and each node of a tree a Krichevsky-Trofimov
estimate. A node's probability of what was seen in it is the even mixture of its own estimate
and the product over its children; the ratio of the two says how much a prediction trusts the
node itself rather than the longer contexts below it.
"""

from __future__ import annotations

import numpy as np

DEPTH = 4
TOP = 2  # there are at most 2**16 contexts of this length, whatever the text
STOP = 0xFF  # no byte of UTF-8: ends a text, and stands before it


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps of the recurrence; for x of 0.5 and more."""
    shift = np.zeros_like(x)
    for n in range(8):
        shift += np.log(x + n)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - shift


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi))


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the texts and the stop after each: the byte with the ``depth`` bytes before
    it as one number, oldest byte highest. The second array has the count of each text."""
    pad = bytes([STOP]) * depth
    stream = np.frombuffer(pad + pad.join(texts) + pad[:1], np.uint8).astype(np.uint64)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    codes = np.zeros(len(stream) - depth, np.uint64)
    for n in range(depth + 1):
        codes |= stream[depth - n : len(stream) - n] << np.uint64(8 * n)
    starts = np.cumsum(sizes + depth - 1) - (sizes + depth - 1)
    keep = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return codes[keep], sizes


def decisions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node keys (context, bits before) and the bits decided, a row for each of the eight."""
    context, byte = codes >> np.uint64(8), codes & np.uint64(255)
    level = np.arange(8, dtype=np.uint64)[:, None]
    path = (np.uint64(1) << level) | (byte[None, :] >> (np.uint64(8) - level))
    return (context[None, :] << np.uint64(8)) | path, ((byte[None, :] >> (np.uint64(7) - level)) & np.uint64(1)).astype(np.int64)


def nodes_of(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted node keys with the zeros and ones seen in each."""
    nodes, bits = decisions(codes)
    keys, at = np.unique(nodes.ravel(), return_inverse=True)
    weights = np.repeat(n[None, :].astype(float), 8, axis=0).ravel()
    ones = np.bincount(at, weights * bits.ravel(), len(keys))
    return keys, np.bincount(at, weights, len(keys)) - ones, ones


def low_bytes(codes: np.ndarray, n: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers that are left with ``depth`` bytes before the last, and their counts."""
    keys, at = np.unique(codes & np.uint64((1 << 8 * (depth + 1)) - 1), return_inverse=True)
    return keys, np.bincount(at, n, len(keys))


def mixed(own: np.ndarray, split: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The trust in nodes against the contexts below them, and the logarithm of what both give."""
    return 1 / (1 + np.exp(np.clip(split - own, -700, 700))), np.logaddexp(own, split) + np.log(0.5)


def parents(keys: np.ndarray, depth: int, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Keys of the nodes at ``depth`` above ``keys``, without the oldest byte, and the sums over their children."""
    up, at = np.unique(keys & np.uint64((1 << 8 * (depth + 1)) - 1), return_inverse=True)
    return up, *(np.bincount(at, x, len(up)) for x in sums)


class Top:
    """Nodes of the depths 0 to ``TOP``, from those at ``TOP`` with the sums over their children."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray):
        order = np.argsort(keys)
        keys, zeros, ones, split = keys[order], zeros[order], ones[order], split[order]
        self.levels = []
        for depth in range(TOP, -1, -1):
            trust, below = mixed(log_estimate(zeros, ones), split)
            self.levels.insert(0, (keys, zeros, ones, trust))
            if depth:
                keys, zeros, ones, split = parents(keys, depth - 1, zeros, ones, below)


class LogTable:
    """Open addressing from numbers to logarithms."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        bits = max(8, int(4 * len(codes)).bit_length())
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.table, self.value, used = np.zeros(size, np.uint64), np.zeros(size), np.zeros(size, bool)
        left, at = codes, self._slot(codes)
        self.steps = 0
        while len(left):
            self.steps += 1
            new = np.zeros(len(left), bool)
            new[np.unique(at, return_index=True)[1]] = True
            new &= ~used[at]
            self.table[at[new]], self.value[at[new]] = left[new], values[new]
            used[at[new]] = True
            left, values, at = left[~new], values[~new], (at[~new] + 1) % size
        self.value[~used] = np.nan

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """The logarithm of each number, not a number where it is not in the table."""
        at = self._slot(codes)
        out = np.where(self.table[at] == codes, self.value[at], np.nan)
        open_ = np.flatnonzero(np.isnan(out))
        if len(open_):
            rest, back = np.unique(codes[open_], return_inverse=True)
            at, found = self._slot(rest), np.full(len(rest), np.nan)
            for _ in range(self.steps):
                found = np.where(np.isnan(found) & (self.table[at] == rest), self.value[at], found)
                at = (at + 1) % len(self.table)
            out[open_] = found[back]
        return out


class ContextTree:
    """The trees of all 255 decisions. ``counts[d]`` are (number, count) arrays of bytes with the
    ``d`` bytes before them. With ``top``, the shallow nodes are taken from there and ``counts`` are those of
    the depths below; they may be of some contexts of ``TOP + 1`` bytes only, each with all that is below it."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], top: Top | None = None):
        above = top.levels if top else []
        self.keys, self.zeros, self.ones, self.trust = ([x[n] for x in above] for n in range(4))
        for codes, n in counts:
            for kept, got in zip((self.keys, self.zeros, self.ones), nodes_of(codes, n)):
                kept.append(got)
            self.trust.append(None)
        self.depth = len(self.keys) - 1
        self._weigh(len(above))
        self.table = None
        if not top:
            self.table = LogTable(codes, self.log10(codes))

    def _weigh(self, first: int) -> None:
        """Trusts from the deepest level up to ``first``; ``below`` stays as it is there."""
        self.below = log_estimate(self.zeros[-1], self.ones[-1])
        for d in range(self.depth - 1, first - 1, -1):
            child = self.keys[d + 1]
            kept = (np.uint64(1) << np.uint64(8 * (d + 1))) - np.uint64(1)  # drops the oldest byte
            at = np.searchsorted(self.keys[d], child & kept)
            size = len(self.keys[d])
            rest_zeros = self.zeros[d] - np.bincount(at, self.zeros[d + 1], size)
            rest_ones = self.ones[d] - np.bincount(at, self.ones[d + 1], size)
            split = np.bincount(at, self.below, size) + log_estimate(np.maximum(rest_zeros, 0), np.maximum(rest_ones, 0))
            self.trust[d], self.below = mixed(log_estimate(self.zeros[d], self.ones[d]), split)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each byte after its context."""
        nodes, bits = decisions(codes)
        total = np.zeros(len(codes))
        for node, bit in zip(nodes, bits):
            p = np.full(len(codes), 0.5)
            deeper = np.zeros(len(codes), bool)
            for d in range(self.depth, -1, -1):
                if not len(self.keys[d]):
                    continue
                key = node & ((np.uint64(1) << np.uint64(8 * (d + 1))) - np.uint64(1))
                at = np.minimum(np.searchsorted(self.keys[d], key), len(self.keys[d]) - 1)
                there = self.keys[d][at] == key
                seen = np.where(bit == 1, self.ones[d][at], self.zeros[d][at])
                own = (seen + 0.5) / (self.zeros[d][at] + self.ones[d][at] + 1)
                trust = np.where(deeper, self.trust[d][at] if d < self.depth else 1.0, 1.0)
                p = np.where(there, trust * own + (1 - trust) * p, p)
                deeper |= there
            total += np.log10(p)
        return total

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """As ``log10``, by the table where it can."""
        out = self.table.find(codes)
        open_ = np.flatnonzero(np.isnan(out))
        if len(open_):
            unseen, back = np.unique(codes[open_], return_inverse=True)
            out[open_] = self.log10(unseen)[back]
        return out


NO_TOP = Top(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0), np.zeros(0))


def lower_tree(codes: np.ndarray, n: np.ndarray, top: Top = NO_TOP) -> ContextTree:
    """The tree of some contexts of ``TOP + 1`` bytes: ``codes`` are all the numbers that end in them."""
    return ContextTree([low_bytes(codes, n, d) for d in range(TOP + 1, DEPTH + 1)], top)
