"""Words of many texts at once, as positions and 64-bit hashes over one UTF-8 byte array.

A word is a longest run of bytes other than space and 9 to 13 (``[^\\x20\\x09-\\x0D]+``); these are all
ASCII, so bytes and characters agree on where words are.
"""

from __future__ import annotations

import numpy as np

from tidemill.llm.common import ranges

BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the base modulo 2**64, or of its inverse."""
    name = "inverse" if inverse else "plain"
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        base = pow(BASE, -1, 2 ** 64) if inverse else BASE
        have = np.ones(1, np.uint64)
        with np.errstate(over="ignore"):
            while len(have) < n:
                have = np.concatenate([have, have * np.uint64(pow(base, len(have), 2 ** 64))])
        _POWERS[name] = have
    return have[:n]


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: close inputs give unrelated outputs."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2 ** 64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Sums of (value + 1) * base**i over every prefix, modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values)), out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hashes of the stretches [start, end) from their prefix sums, wherever they stand."""
    with np.errstate(over="ignore"):
        h = (prefix[ends] - prefix[starts]) * powers(int(len(prefix)), True)[starts]
        return mix(h + (ends - starts).astype(np.uint64), seed)


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte positions of all words, and the row's first word for each row and the end."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = offsets[1:-1]
    inner = inner[inner < len(data)]
    begin[inner] = solid[inner]
    starts = np.flatnonzero(begin)
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    last = offsets[1:] - 1
    last = last[last >= 0]
    stop[last] = solid[last]
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return stretch_hash(prefix_hash(data), starts, ends, seed) if len(starts) else np.zeros(0, np.uint64)


def window_hashes(hashes: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """The hash of each run of ``size`` hashes, by its first position; runs may cross rows."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * np.uint64(BASE) + hashes[k:k + len(out)]
    return mix(out, seed)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def starts_inside(first: np.ndarray, size: int) -> np.ndarray:
    """Positions at which a run of ``size`` words lies within its row."""
    return ranges(first[:-1], np.maximum(np.diff(first) - size + 1, 0))
