"""Word positions and hashes of whole Arrow text columns, by NumPy over the UTF-8 bytes.

A text column is walked in chunks of whole rows, so the arrays of one step stay small however many
rows a batch has. Nulls count as empty texts. Words are byte runs; every class of bytes used here
treats the bytes of one UTF-8 character alike, so byte runs and character runs are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
#: The same for steps that keep little of a chunk: their arrays take up to 60 bytes a byte of text.
SMALL_CHUNK_BYTES = 1 << 18

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Byte classes: 0 separates words.
NOT_SPACE = np.ones(256, np.uint8)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = 0
ALNUM = np.zeros(256, np.uint8)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = 1
#: Letters, digits and all beyond ASCII are 1; other visible bytes are 2, so "a,b" is three words.
WORD_OR_SIGN = np.where(ALNUM == 1, 1, NOT_SPACE * 2).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE_LOWER = BYTE_VALUES[LOWER]


class _Powers:
    """Powers of an odd base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_powers = _Powers()


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run ``values[start:end]``, by prefix sums; equal runs have equal hashes."""
    up, down = _powers.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


@dataclass
class Words:
    """Words of consecutive texts: hash, byte range and the text's index, in order."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    offsets: np.ndarray
    data: np.ndarray

    @property
    def texts(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.texts)

    @property
    def firsts(self) -> np.ndarray:
        """Index of the first word of each text, and the number of words at the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, offsets from 0) of row ranges with ``limit`` bytes, or one longer text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string()) if len(column) else column.cast(pa.large_string())
    rows = len(column)
    if not rows:
        return
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + rows + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words_of(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """All words of the texts that ``offsets`` cut out of ``data``; A-Z count as a-z if ``lower``."""
    n = len(data)
    kind = classes[data]
    if n == 0:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, empty, offsets, data)
    edge = np.ones(n + 1, bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[offsets] = True
    cuts = np.flatnonzero(edge)
    starts, ends = cuts[:-1], cuts[1:]
    real = kind[starts] > 0
    starts, ends = starts[real], ends[real]
    hashes = run_hashes((_BYTE_LOWER if lower else BYTE_VALUES)[data], starts, ends)
    return Words(hashes, starts, ends, np.searchsorted(offsets, starts, "right") - 1, offsets, data)


def grams(words: Words, size: int, whole_if_fewer: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of one text and the text of each.

    ``whole_if_fewer``: a text with fewer words, but not none, has its whole sequence as one.
    """
    firsts, counts = words.firsts, words.counts
    starts = np.arange(max(0, len(words.hash) - size + 1))
    starts = starts[words.text[starts] == words.text[starts + size - 1]] if len(starts) else starts
    ends = starts + size
    if whole_if_fewer:
        few = np.flatnonzero((counts > 0) & (counts < size))
        starts, ends = np.concatenate((starts, firsts[few])), np.concatenate((ends, firsts[few] + counts[few]))
    owner = words.text[starts]
    if whole_if_fewer:
        order = np.argsort(owner, kind="stable")
        starts, ends, owner = starts[order], ends[order], owner[order]
    return run_hashes(words.hash, starts, ends), owner


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
