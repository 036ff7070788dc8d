"""A bigram trie in Elias-Fano levels, laid out in one buffer that can be memory-mapped.

Level one: the contexts, and for each the place where its successors begin. Level two: the successors, each
context's own in rising order, made monotone over the whole level by adding what came before, and one
byte a successor for its log10 probability. Contexts, pointers and successors are Elias-Fano sequences:
low bits side by side, high bits in unary, with the number of ones before each 512 bits to find the i-th.
"""

from __future__ import annotations

import struct

import numpy as np

_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _i in enumerate(i for i in range(8) if _b >> i & 1):
        _SELECT[_b, _k] = _i


class EliasFano:
    """Random access to a rising sequence of whole numbers below 2**62."""

    def __init__(self, data: memoryview) -> None:
        self.n, self.low_bits, low, high, tops = struct.unpack_from("<QQQQQ", data)
        at = 40
        self.low = np.frombuffer(data, np.uint8, low, at)
        self.high = np.frombuffer(data, "<u8", high, at + low)
        self.tops = np.frombuffer(data, "<u8", tops, at + low + 8 * high)
        self.size = at + low + 8 * (high + tops)

    @staticmethod
    def build(values: np.ndarray) -> bytes:
        n = len(values)
        values = values.astype(np.uint64)
        top = int(values[-1]) + 1 if n else 1
        low_bits = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        bits = np.zeros((n, low_bits), np.uint8)
        for k in range(low_bits):
            bits[:, k] = values >> np.uint64(k) & np.uint64(1)
        # eight spare bytes, so that whole words can be read at any place; a multiple of eight
        packed = np.packbits(bits, bitorder="little").tobytes()
        low = packed + bytes(16 - len(packed) % 8)
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        words = ((int(places[-1]) if n else 0) // 512 + 1) * 8
        unary = np.zeros(words * 64, np.uint8)
        unary[places] = 1
        high = np.packbits(unary, bitorder="little").view("<u8")
        ones = np.bitwise_count(high).reshape(-1, 8).sum(axis=1)
        tops = np.concatenate(([0], np.cumsum(ones))).astype("<u8")
        return struct.pack("<QQQQQ", n, low_bits, len(low), len(high), len(tops)) + low + high.tobytes() + tops.tobytes()

    def values(self) -> np.ndarray:
        """The whole sequence, decoded in one pass."""
        i = np.arange(self.n)
        place = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        return self._join(i, place)

    def _join(self, i: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The values whose ones stand at ``place``, with their low bits."""
        value = (place - i).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            at = i * self.low_bits
            words = np.lib.stride_tricks.sliding_window_view(self.low, 8)
            raw = words[at >> 3].copy().view("<u8")[:, 0]
            value |= raw >> (at & 7).astype(np.uint64) & np.uint64((1 << self.low_bits) - 1)
        return value

    def __getitem__(self, index: np.ndarray) -> np.ndarray:
        """The values at the given places."""
        i = index.astype(np.int64)
        block = np.searchsorted(self.tops, i, "right") - 1
        left = i - self.tops[block].astype(np.int64)
        words = self.high[block[:, None] * 8 + np.arange(8)]
        word, left = _find(np.bitwise_count(words).astype(np.int64), left)
        own = words[np.arange(len(i)), word]
        octets = own[:, None] >> (np.arange(8, dtype=np.uint64) * np.uint64(8)) & np.uint64(255)
        octet, left = _find(np.bitwise_count(octets).astype(np.int64), left)
        bit = _SELECT[octets[np.arange(len(i)), octet].astype(np.int64), left]
        return self._join(i, block * 512 + word * 64 + octet * 8 + bit)


def _find(ones: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In each row of counts, the column that holds the ``left``-th one, and its number there."""
    ends = np.cumsum(ones, axis=1)
    column = (ends <= left[:, None]).sum(axis=1)
    row = np.arange(len(left))
    return column, left - (ends[row, column] - ones[row, column])


def _search(values: EliasFano, key: np.ndarray, low: np.ndarray, high: np.ndarray, add: np.ndarray) -> np.ndarray:
    """For each key its place among ``values[low:high] - add`` (rising), or -1."""
    low, high = low.copy(), high.copy()
    end = high.copy()
    active = np.flatnonzero(low < high)
    while len(active):
        middle = (low[active] + high[active]) // 2
        less = values[middle] - add[active] < key[active]
        low[active[less]] = middle[less] + 1
        high[active[~less]] = middle[~less]
        active = active[low[active] < high[active]]
    found = np.flatnonzero(low < end)
    hit = found[values[low[found]] - add[found] == key[found]]
    out = np.full(len(key), -1)
    out[hit] = low[hit]
    return out


class Trie:
    """Log10 probabilities of (context, successor) pairs."""

    def __init__(self, data: memoryview) -> None:
        self.step, size = struct.unpack_from("<dQ", data)
        at, levels = 16, []
        for _ in range(4):
            levels.append(EliasFano(data[at:]))
            at += levels[-1].size
        self.contexts, self.pointers, self.bases, self.successors = levels
        self.levels = np.frombuffer(data, np.uint8, size, at)

    @staticmethod
    def build(context: np.ndarray, successor: np.ndarray, log10p: np.ndarray) -> bytes:
        """Pairs sorted by context and successor, each once, with their log10 probabilities."""
        contexts, first = np.unique(context, return_index=True)
        count = np.diff(first, append=len(context))
        last = successor[first + count - 1] + 1 if len(first) else np.zeros(0, np.int64)
        bases = np.concatenate(([0], np.cumsum(last)))[: len(first)]
        step = max(1e-6, float(-log10p.min()) / 255) if len(log10p) else 1.0
        levels = np.rint(-log10p / step).clip(0, 255).astype(np.uint8)
        parts = (contexts, np.concatenate((first, [len(context)])), bases, successor + np.repeat(bases, count))
        return struct.pack("<dQ", step, len(levels)) + b"".join(EliasFano.build(p) for p in parts) + levels.tobytes()

    def find(self, context: np.ndarray, successor: np.ndarray) -> np.ndarray:
        """The place of each pair in level two, or -1: first the context, then the successor in its range.

        Many pairs are searched in levels decoded once, few by random access.
        """
        out = np.full(len(context), -1)
        n = self.contexts.n
        if not n or not len(context):
            return out
        if 8 * len(context) >= self.successors.n:
            contexts, pointers, bases, successors = (x.values() for x in (self.contexts, self.pointers, self.bases, self.successors))
            at = np.minimum(np.searchsorted(contexts, context.astype(np.uint64)), n - 1)
            wanted = successor.astype(np.uint64) + bases[at]
            place = np.searchsorted(successors, wanted)
            within = (contexts[at] == context.astype(np.uint64)) & (place < pointers[at + 1].astype(np.int64))
            within[within] = successors[place[within]] == wanted[within]
            return np.where(within, place, -1)
        zero = np.zeros(len(context), np.uint64)
        at = _search(self.contexts, context.astype(np.uint64), np.zeros(len(context), np.int64), np.full(len(context), n), zero)
        known = np.flatnonzero(at >= 0)
        low, high = self.pointers[at[known]].astype(np.int64), self.pointers[at[known] + 1].astype(np.int64)
        out[known] = _search(self.successors, successor[known].astype(np.uint64), low, high, self.bases[at[known]])
        return out

    def log10(self, place: np.ndarray) -> np.ndarray:
        return self.levels[place] * -self.step
