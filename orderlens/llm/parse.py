"""Recompression of word sequences: rounds that name runs and pairs, and the anchors that windows choose among the names.

A name is a 64-bit hash of what it stands for, and whether two neighbours form a pair depends on their names alone.
So names agree across documents, tasks and runs of the job without a dictionary, and equal passages get equal
symbols except near their ends. `left` and `right` bound the words on which a symbol depends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from orderlens.llm.words import Words, mix, powers

ROUNDS = 3
_PAIR, _RUN, _RANK, _SPAN = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))


@dataclass
class Symbols:
    """Symbols in text order."""

    name: np.ndarray
    first: np.ndarray  # first word
    left: np.ndarray  # depends on words left .. right - 1; outside the text at its ends
    right: np.ndarray
    text: np.ndarray
    bounds: np.ndarray  # text t has words bounds[t] to bounds[t + 1]


def _merged(s: Symbols, head: np.ndarray, name: np.ndarray) -> Symbols:
    """Symbols that start at the old ones in `head`; each now depends on its old neighbours as well."""
    tail = np.append(head[1:], len(s.name)) - 1
    left, right = s.bounds[s.text[head]] - 1, s.bounds[s.text[tail] + 1] + 1  # without a neighbour: on the text's end
    inner = np.flatnonzero((head > 0) & (s.text[head] == s.text[head - 1]))
    left[inner] = s.left[head[inner] - 1]
    inner = np.flatnonzero(tail + 1 < len(s.name))
    inner = inner[s.text[tail[inner]] == s.text[tail[inner] + 1]]
    right[inner] = s.right[tail[inner] + 1]
    return Symbols(name, s.first[head], left, right, s.text[head], s.bounds)


def _name_runs(s: Symbols) -> Symbols:
    new = np.ones(len(s.name), bool)
    new[1:] = (s.name[1:] != s.name[:-1]) | (s.text[1:] != s.text[:-1])
    head = np.flatnonzero(new)
    length = np.diff(np.append(head, len(s.name)))
    name = s.name[head]
    name = np.where(length > 1, mix(name * _RUN + length.astype(np.uint64)), name)
    return _merged(s, head, name)


def _name_pairs(s: Symbols, round_: int) -> Symbols:
    """A pair is a symbol of the round's left half of the alphabet before one of the right half."""
    right_half = (mix(s.name + np.uint64(round_ + 1)) & np.uint64(1)).astype(bool)
    opens = np.zeros(len(s.name), bool)
    opens[:-1] = ~right_half[:-1] & right_half[1:] & (s.text[1:] == s.text[:-1])
    keep = np.ones(len(s.name), bool)
    keep[1:] = ~opens[:-1]
    head = np.flatnonzero(keep)
    name = s.name[head]
    pair = opens[head]
    name[pair] = mix(name[pair] * _PAIR + s.name[head[pair] + 1])
    return _merged(s, head, name)


def symbols(words: Words, hashes: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    at = np.arange(len(hashes), dtype=np.int64)
    s = Symbols(hashes, at, at, at + 1, words.text, words.bounds)
    for r in range(rounds):
        s = _name_pairs(_name_runs(s), r)
    return s


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high], for nonempty ranges."""
    size = high - low
    out = np.empty(len(low), values.dtype)
    step, table = 1, values
    while True:
        mine = np.flatnonzero((size >= step) & (size < 2 * step))
        out[mine] = np.minimum(table[low[mine]], table[high[mine] - step])
        if not (size >= 2 * step).any():
            return out
        table = np.minimum(table[:-step], table[step:])
        step *= 2


@dataclass
class Spans:
    """Runs of window starts that share an anchor: its name, the first start and the number of starts."""

    name: np.ndarray
    low: np.ndarray
    count: np.ndarray


def rolling(hashes: np.ndarray) -> np.ndarray:
    """Prefix sums from which `content` takes the hash of any stretch of words."""
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(len(hashes))[0], out=out[1:])
    return out


def content(prefix: np.ndarray, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return mix((prefix[start + length] - prefix[start]) * powers(len(prefix))[1][start])


def spans(words: Words, hashes: np.ndarray, prefix: np.ndarray, window: int, rounds: int = ROUNDS) -> Spans:
    """The anchor of each window is the least symbol that depends on words of the window alone; a window without
    one (the inside of a long run) is its own anchor, named by its content."""
    counts = words.counts() - window + 1
    owners = np.flatnonzero(counts > 0)
    n = counts[owners]
    if not len(n):
        none = np.zeros(0, np.int64)
        return Spans(np.zeros(0, np.uint64), none, none)
    ends = np.cumsum(n)
    start = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(words.bounds[owners], n)
    s = symbols(words, hashes, rounds)
    low = np.searchsorted(s.left, start)
    high = np.searchsorted(s.right, start + window, side="right")
    has = high > low
    # 32 bits of rank, then the place: of equal ranks the first in the window
    rank = (mix(s.name * _RANK) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(s.name), dtype=np.uint64)
    anchor = np.full(len(start), -1, np.int64)
    if has.any():
        anchor[has] = (_least(rank, low[has], high[has]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (anchor[1:] < 0) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    anchored = anchor[head] >= 0
    name = np.empty(len(head), np.uint64)
    chosen = anchor[head[anchored]]
    # every word that a symbol depends on is in the window, so it may tell symbols of the same name apart
    context = content(prefix, s.left[chosen], s.right[chosen] - s.left[chosen])
    name[anchored] = mix(s.name[chosen] * _PAIR + context)
    name[~anchored] = content(prefix, start[head[~anchored]], window)
    count = np.diff(np.append(head, len(start)))
    return Spans(name, start[head], count)
