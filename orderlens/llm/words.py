"""Words and their hashes for whole Arrow columns, in bounded pieces and without a Python loop over words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 19  # texts are taken in pieces of about this size; a longer text is a piece of its own

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=1)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, 2 * PIECE_BYTES), _powers(pow(_BASE, -1, 1 << 64), 2 * PIECE_BYTES)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base and of its inverse, modulo 2^64."""
    if n <= 2 * PIECE_BYTES:
        up, down = _usual_powers()
        return up[:n], down[:n]
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


@dataclass
class Words:
    """The words of some texts: byte positions, the text each word belongs to, and each text's range of words."""

    data: np.ndarray  # the texts' bytes, one after another
    offsets: np.ndarray  # text t has bytes offsets[t] to offsets[t + 1]
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray  # text t has words bounds[t] to bounds[t + 1]

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
        """A 64-bit hash of each word; `values` gives each byte's value."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = powers(len(self.data))
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.start] = 1
        inside[self.end] -= 1
        terms = values[self.data] * up
        terms[np.cumsum(inside[:-1], dtype=np.int8) == 0] = 0
        return mix(np.add.reduceat(terms, self.start) * down[self.start])


def pieces(texts: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(index of the first text, bytes, offsets) of runs of texts of about `size` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def split(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> Words:
    """Words are maximal runs of bytes that `separator` does not mark, within one text."""
    word = ~separator[data]
    n = len(data)
    before = np.zeros(n, bool)
    before[1:] = word[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = word[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(word & ~before)
    return Words(data, offsets, start, np.flatnonzero(word & ~after) + 1, np.searchsorted(start, offsets))


def grams(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n consecutive words of one text, and the positions of their first words."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(count, np.uint64)
    for i in range(n):
        total += hashes[i : i + count] * np.uint64((_BASE * (2 * i + 3)) & _MASK)
    at = np.flatnonzero(text[:count] == text[n - 1 :])
    return mix(total[at]), at


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of integer values over each text's range."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
