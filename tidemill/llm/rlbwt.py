"""A run-compressed Burrows-Wheeler transform with sampled run ends, over a set of byte strings.

The transform of strings that repeat each other falls into few runs. Only at a run's head and tail are the
text position and the length of the match with the suffix sorted before (after) kept; between two such
samples the match of the next text position is shorter by exactly one, so the matching statistics
of all positions stream out of the samples.
"""

from __future__ import annotations

import numpy as np

from tidemill.llm.words import prefix_hash, stretch_hash

SEPARATOR = 256  # sorts with itself; no match runs over it


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions in order of their suffixes, by prefix doubling; suffixes already apart are left alone."""
    n = len(text)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = text + 1
    first = np.zeros(n, np.uint64)
    for k in range(6):  # 9 bits each
        first = first << np.uint64(9) | padded[k:n + k]
    order = np.argsort(first)
    new = np.concatenate([[True], first[order][1:] != first[order][:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]  # the first place of its group
    length = 6
    while length < n:
        group = rank[order]
        tied = np.zeros(n, bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        places = np.flatnonzero(tied)
        if not len(places):
            break
        positions = order[places]
        beyond = positions + length
        second = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = group[places] * (n + 2) + second
        by = np.argsort(key, kind="stable")
        order[places] = positions[by]
        key = key[by]
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[order[places]] = places[np.flatnonzero(head)[np.cumsum(head) - 1]]
        length *= 2
    return order


class RunIndex:
    """The run-length transform of ``text`` (values below 256, strings kept apart by SEPARATOR)."""

    def __init__(self, text: np.ndarray):
        self.n = len(text)
        order = suffix_array(text)
        before = text[order - 1]  # position 0 has the last character before it: a separator
        edge = (before[1:] != before[:-1]) | (before[1:] == SEPARATOR)  # no match reaches back over a separator
        heads = np.concatenate([[True], edge])
        tails = np.concatenate([edge, [True]])
        self.characters = before[heads]
        self.run_lengths = np.diff(np.append(np.flatnonzero(heads), self.n))
        stops = np.flatnonzero(text == SEPARATOR)
        self._ends = stops[np.searchsorted(stops, np.arange(self.n))]
        prefix = prefix_hash(text)
        at = np.flatnonzero(heads)
        self.head_positions = order[at]
        self.head_lengths = self._common(prefix, order[at], np.where(at > 0, order[at - 1], -1))
        at = np.flatnonzero(tails)
        self.tail_positions = order[at]
        after = np.minimum(at + 1, self.n - 1)
        self.tail_lengths = self._common(prefix, order[at], np.where(at + 1 < self.n, order[after], -1))

    def _common(self, prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common beginnings of suffixes, up to a separator; a position below 0 has none."""
        real = b >= 0
        b = np.where(real, b, a)
        low = np.zeros(len(a), np.int64)
        high = np.where(real, np.minimum(self._ends[a] - a, self._ends[b] - b), 0)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = stretch_hash(prefix, a, a + middle) == stretch_hash(prefix, b, b + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def _stream(self, positions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        order = np.argsort(positions)
        positions, lengths = positions[order], lengths[order]
        at = np.searchsorted(positions, np.arange(self.n), "right") - 1
        known = at >= 0
        out = np.where(known, lengths[at] - (np.arange(self.n) - positions[at]), 0)
        return np.maximum(out, 0)

    def matching_statistics(self) -> np.ndarray:
        """For every position the length of the longest match that also starts at another position."""
        return np.maximum(self._stream(self.head_positions, self.head_lengths), self._stream(self.tail_positions, self.tail_lengths))
