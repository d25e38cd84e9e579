"""Pair merges of many words at once.

Each word has an agenda: the rank of every adjacent pair of its symbols, by position. A round takes
from every word the pair of lowest rank (leftmost of equals), merges it, and renews the two entries
beside it; a word is done when no ranked pair is left. All words of a block run their rounds together
as numpy arrays, so a round costs a few array operations and not a few interpreter steps a word.
"""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int32).max
DEAD, PAD = -1, -2
BLOCK = 4096


class PairMerges:
    """``left[i] + right[i]`` gives ``merged[i]`` at ``rank[i]``; symbols are 0 to ``symbols - 1``, lower ranks go first."""

    def __init__(self, left: list[int], right: list[int], merged: list[int], rank: list[int], symbols: int) -> None:
        self.symbols = symbols
        keys = np.array(left, np.int64) * symbols + np.array(right, np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.merged, self.rank = np.array(merged, np.int32)[order], np.array(rank, np.int32)[order]

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE if there is no such pair) and merged symbol."""
        keys = np.where((left < 0) | (right < 0), -1, left.astype(np.int64) * self.symbols + right)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE), self.merged[at]

    def run(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words laid end to end (ids below PAD stand for unknown symbols, which never merge) to merged words, likewise."""
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(lengths, kind="stable")
        counts = np.zeros(len(lengths), np.int64)
        blocks = []
        for at in range(0, len(order), BLOCK):
            rows = order[at : at + BLOCK]
            found, n = self._block(symbols, starts[rows], lengths[rows])
            counts[rows] = n
            blocks.append((rows, found))
        out, begins = np.empty(counts.sum(), np.int32), np.cumsum(counts) - counts
        for rows, found in blocks:
            n = counts[rows]
            out[np.repeat(begins[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = found
        return out, counts

    def _block(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, wide = len(starts), int(lengths.max(initial=0))
        inside = np.arange(wide) < lengths[:, None]
        word = np.full((n, wide + 1), PAD, np.int32)
        word[:, :wide][inside] = symbols[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())]
        after = np.tile(np.arange(1, wide + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, wide, dtype=np.int32), (n, 1))
        agenda, joined = (x.reshape(n, wide) for x in self.look(word[:, :wide].ravel(), word[:, 1:].ravel()))
        rows = np.arange(n)
        while len(rows):
            at = agenda[rows].argmin(1) if wide else rows[:0]
            more = agenda[rows, at] != NONE
            rows, at = rows[more], at[more]
            if not len(rows):
                break
            new, gone = joined[rows, at], after[rows, at]
            following = after[rows, gone]
            word[rows, at], word[rows, gone], agenda[rows, gone] = new, DEAD, NONE
            after[rows, at], before[rows, following] = following, at
            previous = before[rows, at]
            rank, merged = self.look(np.concatenate([new, np.where(previous < 0, DEAD, word[rows, previous])]), np.concatenate([word[rows, following], new]))
            agenda[rows, at], joined[rows, at] = rank[: len(rows)], merged[: len(rows)]
            has = previous >= 0
            agenda[rows[has], previous[has]], joined[rows[has], previous[has]] = rank[len(rows) :][has], merged[len(rows) :][has]
        left = (word[:, :wide] != DEAD) & inside
        return word[:, :wide][left], left.sum(1)
