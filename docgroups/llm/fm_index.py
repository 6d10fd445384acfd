"""A bidirectional FM-index over word ids, limited to phrases of a few words.

Suffixes are sorted by their first ``depth`` words only, which is all that phrases of that length need. The
index holds the word before each suffix (the transform) of the text and of its mirror image. A phrase is an interval of
suffixes in both. Adding a word on the left narrows the interval of the text by rank queries on its transform, and
shifts that of the mirror image by the occurrences of smaller words; adding one on the right does the same the
other way round. All intervals of a length are extended by all words at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BREAK = 0  # the id between pieces; no phrase holds it


def _order(x: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the ``depth`` ids that begin there; what lies beyond the end counts as a break."""
    base = int(x.max()) + 1
    key = x.astype(np.int64)
    for shift in range(1, depth):
        if int(key.max()) >= (1 << 62) // base:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        later = np.zeros(x.size, dtype=np.int64)
        later[:x.size - shift] = x[shift:]
        key = key * base + later
    return np.argsort(key, kind="stable")


class _Transform:
    """The sorted suffixes of one direction: their first ids, the ids before them, and ranks of the latter."""

    def __init__(self, x: np.ndarray, depth: int):
        places = _order(x, depth)
        self.before = x[places - 1]  # the text begins with a break, which stands for what is before its start
        self.first = np.concatenate([[0], np.cumsum(np.bincount(x))])
        self.size = x.size
        # Every (id, place) pair of the transform in order: a rank is a search in it.
        self.keys = np.sort(self.before.astype(np.int64) * x.size + np.arange(x.size))
        self.starts = np.searchsorted(self.keys, np.arange(self.first.size, dtype=np.int64) * x.size)

    def rank(self, word: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often ``word`` stands before the first ``place`` suffixes."""
        return np.searchsorted(self.keys, word.astype(np.int64) * self.size + place) - self.starts[word]


@dataclass
class Phrases:
    """Phrases of one length: ``words`` (phrases x length), their first suffix in both directions, how often they occur."""

    words: np.ndarray
    low: np.ndarray
    mirror_low: np.ndarray
    count: np.ndarray

    def where(self, kept: np.ndarray) -> Phrases:
        return Phrases(self.words[kept], self.low[kept], self.mirror_low[kept], self.count[kept])


class Index:
    """``x``: ids from 1 on, BREAK between pieces and at both ends."""

    def __init__(self, x: np.ndarray, depth: int):
        self.forward = _Transform(x, depth)
        self.mirror = _Transform(x[::-1], depth)
        self.words = int(x.max())

    def single(self) -> Phrases:
        """All words of the text."""
        word = np.arange(1, self.words + 1)
        low = self.forward.first[word]
        return Phrases(word[:, None], low, low.copy(), self.forward.first[word + 1] - low)

    def left(self, of: Phrases) -> Phrases:
        """Every phrase that has one word more on the left."""
        parent, word, count, smaller = self._extensions(self.forward, of.low, of.count)
        low = self.forward.first[word] + self.forward.rank(word, of.low[parent])
        return Phrases(np.column_stack([word, of.words[parent]]), low, of.mirror_low[parent] + smaller, count)

    def right(self, of: Phrases) -> Phrases:
        """Every phrase that has one word more on the right."""
        parent, word, count, smaller = self._extensions(self.mirror, of.mirror_low, of.count)
        low = self.mirror.first[word] + self.mirror.rank(word, of.mirror_low[parent])
        return Phrases(np.column_stack([of.words[parent], word]), of.low[parent] + smaller, low, count)

    def _extensions(self, side: _Transform, low: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each interval and each word beside it: the interval, the word, how often, and how often a smaller id (breaks too) is."""
        parent = np.repeat(np.arange(low.size), count)
        inside = np.arange(parent.size) - np.repeat(np.cumsum(count) - count, count)
        word = side.before[low[parent] + inside]
        base = self.words + 1
        key, times = np.unique(parent * base + word, return_counts=True)
        parent, word = key // base, key % base
        total = np.cumsum(times) - times
        smaller = total - total[np.searchsorted(parent, parent)]
        kept = word != BREAK
        return parent[kept], word[kept], times[kept], smaller[kept]
