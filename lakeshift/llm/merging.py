"""Exact BPE merging of many words at once in numpy.

Each round merges one pair in every word: that of least rank, the leftmost of
equal ones. Words without a pair to merge leave.
"""

from __future__ import annotations

import numpy as np


class Pairs:
    """Which pairs of ids merge, in what order, and into what."""

    def __init__(self, size: int, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray):
        key = left * size + right
        order = np.argsort(key)
        self.size, self.key, self.rank = size, key[order], rank[order]
        self.none = int(rank.max(initial=0)) + 1  # the rank of a pair that does not merge
        self.made = np.zeros(self.none, np.int64)
        self.made[rank] = made

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], self.none)

    def merge(self, at: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Little-endian 32-bit ids of each word, given all words' first ids one after the
        other and how many each word has (at least one)."""
        out: list[bytes] = [b""] * len(lengths)
        which = np.arange(len(lengths))
        first = np.cumsum(lengths) - lengths
        # the pair of a place is with the place after it; a word's last place has none
        rank = np.full(len(at), self.none, np.int64)
        rank[:-1] = self.rank_of(at[:-1], at[1:])
        rank[first + lengths - 1] = self.none
        while len(which):
            least = np.minimum.reduceat((rank << 32) | np.arange(len(at)), first)
            done = (least >> 32) == self.none
            place = least & 0xFFFFFFFF
            if done.any():
                ids = at.astype("<u4").tobytes()
                for w, f, n in zip(which[done].tolist(), first[done].tolist(), lengths[done].tolist(), strict=True):
                    out[w] = ids[4 * f : 4 * (f + n)]
                keep = np.repeat(~done, lengths)
                at, rank = at[keep], rank[keep]
                which, lengths, least, place = which[~done], lengths[~done], least[~done], (place - first)[~done]
                first = np.cumsum(lengths) - lengths
                place += first
                if not len(which):
                    break
            at[place] = self.made[least >> 32]
            keep = np.ones(len(at), bool)
            keep[place + 1] = False
            last = place + 1 == first + lengths - 1  # the merged token ends its word
            at, rank = at[keep], rank[keep]
            place -= np.arange(len(place))  # one place is gone in each word before
            lengths = lengths - 1
            first = np.cumsum(lengths) - lengths
            rank[place[last]] = self.none
            go = place[~last]
            rank[go] = self.rank_of(at[go], at[go + 1])
            back = place[place > first]
            rank[back - 1] = self.rank_of(at[back - 1], at[back])
        return out
