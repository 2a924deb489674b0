"""A wavelet matrix: order statistics of any range of a sequence, many queries at once."""

from __future__ import annotations

import numpy as np


class Wavelet:
    """Whole numbers from 0 to below the sequence's length, in one bit plane per binary digit."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros: list[np.ndarray] = []  # of each plane: zeros before every place
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def smaller(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many of the values at lo..hi-1 are below x (x up to 2**bits)."""
        lo, hi = lo.copy(), hi.copy()
        count = np.where(x >> self.bits > 0, hi - lo, 0)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b, all_zeros = zeros[lo], zeros[hi], zeros[-1]
            one = (x >> bit & 1).astype(bool)
            count += np.where(one & (x >> self.bits == 0), b - a, 0)
            lo = np.where(one, all_zeros + lo - a, a)
            hi = np.where(one, all_zeros + hi - b, b)
        return count

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values at lo..hi-1, which must be so many."""
        lo, hi, k = lo.copy(), hi.copy(), k.copy()
        value = np.zeros(len(lo), np.int64)
        for bit, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            a, b, all_zeros = zeros[lo], zeros[hi], zeros[-1]
            one = k >= b - a
            value |= np.where(one, 1 << bit, 0)
            k = np.where(one, k - (b - a), k)
            lo = np.where(one, all_zeros + lo - a, a)
            hi = np.where(one, all_zeros + hi - b, b)
        return value
