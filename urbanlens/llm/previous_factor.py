"""Suffix order of a block of text, and the longest previous factor of its suffixes.

The suffix order is made by prefix tripling: ranks of 8-byte prefixes give
those of 24, 72... bytes, up to a cap; suffixes equal up to the cap stand in
text order.  The longest earlier match of a suffix is with its previous or its
next neighbour of smaller text position in that order.
"""

from __future__ import annotations

import numpy as np

MOST = 1 << 21                  # three ranks fit one 64-bit key


class SuffixOrder:
    """The order of the suffixes at ``starts``, by their first ``cap`` bytes."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, cap: int):
        if len(data) >= MOST:
            raise ValueError("a block is longer than its ranks allow")
        self.data, self.starts, self.cap = data, starts, cap
        size = min(8, cap)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        key = np.zeros(len(data), np.uint64)
        for i in range(size):
            key = (key << np.uint64(8)) | padded[i:i + len(data)]
        ranks = np.unique(key, return_inverse=True)[1] if len(data) else key.astype(np.int64)
        self.levels = [(size, ranks)]
        while size < cap:
            longer = min(3 * size, cap)
            at = starts if longer == cap else np.arange(len(data))
            key = ranks[at]
            for step in (min(size, longer - size), longer - size):
                key = (key << 21) | self._at(ranks, at + step)
            ranks = np.unique(key, return_inverse=True)[1] if len(at) else key
            size = longer
            if size < cap:
                self.levels.append((size, ranks))
        self.rank = ranks if cap > 8 else ranks[starts]     # of the suffixes at starts alone

    @staticmethod
    def _at(ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ranks[np.minimum(at, max(len(ranks) - 1, 0))]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix lengths, up to the cap, of the suffixes numbered ``a`` and ``b``."""
        x, y = self.starts[a], self.starts[b]
        same = self.rank[a] == self.rank[b]
        out = np.zeros(len(a), np.int64)
        for size, ranks in reversed(self.levels):
            for _ in range(2):
                more = (out + size <= self.cap) & (self._at(ranks, x + out) == self._at(ranks, y + out))
                out[more] += size
        for _ in range(7):
            more = (out < self.cap) & (self._at(self.data, x + out) == self._at(self.data, y + out))
            out[more] += 1
        out[same] = self.cap
        return out


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of the last smaller value before each (or -1), and of the first after it (or the length)."""
    n = len(values)
    before, after = np.arange(-1, n - 1), np.arange(1, n + 1)
    for near, none in ((before, -1), (after, n)):
        active = np.arange(n)
        while True:
            active = active[near[active] != none]
            active = active[values[near[active]] > values[active]]
            if not len(active):
                break
            near[active] = near[near[active]]   # all between are larger than their own nearest
    return before, after


def longest_previous(order: SuffixOrder, position: np.ndarray) -> np.ndarray:
    """Longest previous factor, up to the cap, of each suffix; ``position`` is its (distinct) place in the text."""
    at = np.lexsort((position, order.rank))
    before, after = nearest_smaller(position[at])
    best = np.zeros(len(at), np.int64)
    for near, none in ((before, -1), (after, len(at))):
        some = np.flatnonzero(near != none)
        best[some] = np.maximum(best[some], order.common(at[some], at[near[some]]))
    out = np.empty(len(at), np.int64)
    out[at] = best
    return out
