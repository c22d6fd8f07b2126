"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than white space (9-13 and 32), with A-Z in lower
case. Its hash is a polynomial over random byte values, taken from prefix sums,
then mixed.
"""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(20240607)
_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses modulo 2**64
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes worked on at a time; arrays of eight bytes per byte stay in cache and memory bounds.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` or more powers of the base, and their inverses."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


def _piece_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of a piece that cuts no word."""
    inside = np.zeros(len(data) + 2, bool)
    np.logical_not(_SPACE[data], out=inside[1:-1])
    change = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = change[::2], change[1::2]
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start]), start


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the text) of every word of all texts, in order."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, starts, at = [], [], 0
    while at < len(data):
        to = min(at + PIECE, len(data))
        while to < len(data) and not _SPACE[data[to]]:
            to += 1
        h, s = _piece_words(data[at:to])
        hashes.append(h)
        starts.append(s + at)
        at = to
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(starts), side="right")


def shingles(hashes: np.ndarray, of: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, bounds): the k-word shingles of each text, text i's between
    bounds[i] and bounds[i + 1]; a text with fewer words has all of them as one."""
    count = np.bincount(of, minlength=n_texts)
    first = np.concatenate(([0], np.cumsum(count)))
    made = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bounds = np.concatenate(([0], np.cumsum(made)))
    text = np.repeat(np.arange(n_texts), made)
    at = np.arange(bounds[-1]) - bounds[text] + first[text]
    left = first[text + 1] - at
    out = np.zeros(len(at), np.uint64)
    for j in range(k):
        there = left > j
        out += np.where(there, hashes[np.minimum(at + j, max(len(hashes) - 1, 0))] * _PLACE[j], np.uint64(0)) if len(hashes) else np.uint64(0)
    return mix(out + np.minimum(left, k).astype(np.uint64) * _PLACE[-1]), bounds
