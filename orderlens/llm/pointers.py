"""Word-start pointers into Arrow text buffers: eight bytes at a time, sorted by multikey quicksort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

STEP = 8
_MASKS = np.array([0] + [((1 << 64) - 1) << (64 - 8 * k) & ((1 << 64) - 1) for k in range(1, STEP + 1)], np.uint64)


class Slices:
    """The bytes that pointers stand at, as numbers that sort like the bytes."""

    def __init__(self, data: np.ndarray):
        padded = np.concatenate([data, np.zeros(STEP, np.uint8)])
        self._numbers = np.ndarray(len(data) + 1, ">u8", padded, strides=(1,))

    def at(self, start: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
        """Bytes depth to depth + 8 of every word, zero behind its end."""
        left = np.clip(end - start - depth, 0, STEP)
        where = np.where(left > 0, start + depth, 0)
        return self._numbers[where].astype(np.uint64) & _MASKS[left]


def equal_words(data: Slices, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words a[i] and b[i] are the same text."""
    same = end[a] - start[a] == end[b] - start[b]
    open_, depth = np.flatnonzero(same), 0
    while len(open_):
        x, y = a[open_], b[open_]
        equal = data.at(start[x], end[x], depth) == data.at(start[y], end[y], depth)
        same[open_[~equal]] = False
        depth += STEP
        open_ = open_[equal & (end[x] - start[x] > depth)]
    return same


def sorted_runs(data: Slices, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pointers in the order of what they point to, where runs of equal words begin in that order).

    Every round splits the pointers that still agree by their next eight bytes; words hold no zero byte, so a run is
    complete when its last byte is zero, that is beyond the words' end.
    """
    place = np.zeros(len(start), np.int64)  # first place of the run that a pointer belongs to
    open_, depth = np.arange(len(start)), 0
    while len(open_):
        key = data.at(start[open_], end[open_], depth)
        by = np.lexsort((key, place[open_])) if depth else np.argsort(key, kind="stable")
        open_, key = open_[by], key[by]
        run, here = place[open_], np.arange(len(open_))
        outer, inner = np.ones(len(open_), bool), np.ones(len(open_), bool)
        outer[1:] = run[1:] != run[:-1]
        inner[1:] = outer[1:] | (key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(inner, here, 0))
        place[open_] = run + first - np.maximum.accumulate(np.where(outer, here, 0))
        alone = inner & np.append(inner[1:], True)
        open_ = open_[(key & np.uint64(255) != 0) & ~alone]
        depth += STEP
    order = np.argsort(place, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = place[order][1:] != place[order][:-1]
    return order, np.flatnonzero(new)


def texts_at(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words themselves."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], size)
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at])).cast(pa.string())
