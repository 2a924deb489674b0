"""Prefix-free parsing of texts into overlapping phrases, by rolling-hash triggers.

The trigger of a window of `length` bytes is the byte, among its first `SPAN`, where the
rolling hash of `GRAM` bytes is least. Neighbouring windows with the same trigger are one
phrase; a phrase reaches `length` - 1 bytes over the next, so that every window lies in
exactly one phrase. Triggers depend on the window's bytes alone: equal windows lie at the
same place relative to equal triggers, wherever their texts are cut.

All hashes of a block of text come from prefix sums of a polynomial modulo 2**64.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

GRAM = 16
SPAN = 150
SEGMENT = 1 << 19  # window starts of one text that are handled at once
BLOCK = 1 << 19  # bytes of texts that are handled at once, about

PLACE_BITS = 24  # places in a block

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def key_length(length: int) -> int:
    """Bytes from its trigger on that every window holds."""
    return length - SPAN + 1


@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    up = np.full(size, base, np.uint64)
    down = np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up), np.cumprod(down)


def _values() -> np.ndarray:
    return np.random.default_rng(5).integers(1, 1 << 63, (2, 256), np.uint64) | np.uint64(1)


_VALUES = _values()


def mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(32))


class Rolling:
    """Hashes of any byte ranges of one block of text."""

    def __init__(self, data: np.ndarray, which: int):
        size = 1 << max(12, int(len(data)).bit_length())
        up, self.down = _powers(which, size)
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([
                np.zeros(1, np.uint64), np.cumsum(_VALUES[which][data] * up[: len(data)])
            ])

    def ranges(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[starts]) * self.down[starts])


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` values in a row (by blocks, in linear time)."""
    n = len(values) - span + 1
    if n <= 0:
        return values[:0]
    pad = -len(values) % span
    rows = np.concatenate([values, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])


@dataclass
class Phrases:
    """Phrases of a block: places are relative to the block."""

    start: np.ndarray  # first window
    count: np.ndarray  # windows
    lead: np.ndarray  # trigger, counted from the first window
    key: np.ndarray  # hash of the bytes from the trigger on that all windows hold
    phrase: np.ndarray  # hash of all bytes of the phrase


def parse(data: np.ndarray, length: int, limits: np.ndarray) -> Phrases:
    """Phrases of the texts laid end to end in `data`, the k-th ending at limits[k]."""
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Phrases(none, none, none, none.view(np.uint64), none.view(np.uint64))
    first, second = Rolling(data, 0), Rolling(data, 1)
    at = np.arange(len(data) - GRAM + 1)
    places = np.uint64(PLACE_BITS)  # the same for all blocks, so that all choose alike
    rank = (first.ranges(at, at + GRAM) >> places << places) | at.astype(np.uint64)
    low = np.uint64((1 << PLACE_BITS) - 1)
    trigger = (_least(rank, SPAN)[:n] & low).astype(np.int64)
    bounds = np.concatenate([[0], limits])
    inside = np.zeros(n + 1, np.int64)
    lo, hi = bounds[:-1], limits - length + 1
    real = hi > lo
    np.add.at(inside, lo[real], 1)
    np.add.at(inside, hi[real], -1)
    valid = np.cumsum(inside[:n]) > 0
    new = valid.copy()
    new[1:] &= (trigger[1:] != trigger[:-1]) | ~valid[:-1]
    new[np.minimum(lo[real], n - 1)] = True
    start = np.flatnonzero(new)
    stop = valid.copy()
    stop[:-1] &= new[1:] | ~valid[1:]
    count = np.flatnonzero(stop) - start + 1
    lead = trigger[start] - start
    key = first.ranges(trigger[start], trigger[start] + key_length(length))
    phrase = second.ranges(start, start + count - 1 + length)
    return Phrases(start, count, lead, key, phrase)


def segments(size: int, length: int):
    """(begin, end) of the parts of a text that are parsed at once; they overlap so that
    every window lies in one part, and windows start in one part only."""
    if size < length:
        return
    for begin in range(0, size - length + 1, SEGMENT):
        yield begin, min(size, begin + SEGMENT + length - 1)
