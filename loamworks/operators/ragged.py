"""Rows of different lengths as flat NumPy arrays with offsets."""

from __future__ import annotations

import numpy as np


class Growing:
    """A NumPy array that grows by doubling."""

    def __init__(self, kind: type):
        self.data, self.n = np.zeros(1024, kind), 0

    def add(self, more: np.ndarray) -> None:
        end = self.n + len(more)
        if end > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(end, len(self.data)), self.data.dtype)])
        self.data[self.n : end] = more
        self.n = end

    def view(self) -> np.ndarray:
        return self.data[: self.n]


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places [start, start + length) of every pair, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(lengths)]
