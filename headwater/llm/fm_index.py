"""A compressed full-text index over integer sequences: backward search by rank queries on a wavelet matrix.

The text is held as its Burrows-Wheeler transform, in one bit vector a bit of the symbols; a rank query
reads one running count and one popcount a level. Suffixes are sorted by their first ``depth`` symbols,
which is all that patterns of up to ``depth`` symbols need. All queries take whole arrays of patterns.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank queries on ``symbols`` below ``size``: ``move`` maps a position through all levels."""

    def __init__(self, symbols: np.ndarray, size: int) -> None:
        self.bits = max(1, int(size - 1).bit_length())
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for level in range(self.bits - 1, -1, -1):
            ones = ((symbols >> level) & 1).astype(bool)
            padded = np.zeros((len(symbols) // 64 + 1) * 64, np.uint8)
            padded[: len(symbols)] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))[:-1]
            zeros = len(symbols) - int(ones.sum())
            self.levels.append((words, before, zeros))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def move(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """For each position, where the symbol's first occurrence from there on sorts to (all its occurrences are in a row)."""
        for level, (words, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels, strict=True):
            block = at >> 6
            inside = words[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
            ones = before[block] + np.bitwise_count(inside)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at


def sort_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions in the order of their first ``depth`` symbols or more, by doubling the compared length."""
    order = np.argsort(text, kind="stable")
    rank = _ranks(text[order], order)
    reach = 1
    while reach < depth and len(order) and rank[order[-1]] < len(order):
        later = np.zeros(len(text), np.int64)
        later[: len(text) - reach] = rank[reach:]
        pair = rank * (len(text) + 1) + later
        order = np.argsort(pair, kind="stable")
        rank = _ranks(pair[order], order)
        reach *= 2
    return order


def _ranks(sorted_keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """From 1; equal keys have equal ranks."""
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(np.concatenate(([1], sorted_keys[1:] != sorted_keys[:-1]))) if len(order) else 0
    return rank


class FMIndex:
    """Index of ``text``, whose symbols are 0 (a border that no pattern holds) to ``size`` - 1 and whose last is 0."""

    def __init__(self, text: np.ndarray, size: int, depth: int) -> None:
        order = sort_suffixes(text, depth)
        counts = np.bincount(text, minlength=size)
        self.first = np.concatenate(([0], np.cumsum(counts)))
        self.wavelet = WaveletMatrix(text[order - 1], size)
        # what a symbol's rank has to be raised by to be its place among the sorted suffixes
        self.shift = self.first[:-1] - self.wavelet.move(np.zeros(size, np.int64), np.arange(size))

    def matching(self, text: np.ndarray, ends: np.ndarray, longest: int, times: int = 2) -> np.ndarray:
        """Matching statistics: for each end position in ``text``, the length, ``longest`` at most, of the longest
        run of symbols ending there that occurs at least ``times`` times in the index."""
        length = np.zeros(len(ends), np.int64)
        alive = np.arange(len(ends))
        symbol = text[ends]
        low, high = self.first[symbol], self.first[symbol + 1]
        for step in range(1, longest + 1):
            found = high - low >= times
            alive, low, high = alive[found], low[found], high[found]
            length[alive] = step
            if step == longest or not len(alive):
                break
            symbol = text[ends[alive] - step]
            inside = symbol > 0  # no run goes beyond a border
            alive, low, high, symbol = alive[inside], low[inside], high[inside], symbol[inside]
            both = self.wavelet.move(np.concatenate((low, high)), np.concatenate((symbol, symbol)))
            low, high = both[: len(low)] + self.shift[symbol], both[len(low) :] + self.shift[symbol]
        return length
