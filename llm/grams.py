"""Byte n-grams as packed numbers, and their counts within a task."""

from __future__ import annotations

import numpy as np

# Grams that a task gathers before it counts them.
BUFFER = 1 << 22


def packed(codes: np.ndarray, order: int) -> np.ndarray:
    """The gram that ends at each place from `order - 1` on; the last byte is the lowest."""
    wide = codes.astype(np.uint64)
    keys = wide[order - 1 :].copy()
    for back in range(1, order):
        keys |= wide[order - 1 - back : len(wide) - back] << np.uint64(8 * back)
    return keys


def suffix(keys: np.ndarray, order: int) -> np.ndarray:
    """The last `order` bytes of each gram."""
    return keys & np.uint64((1 << (8 * order)) - 1)


class GramCounter:
    """Counts of packed grams, in sorted arrays."""

    def __init__(self):
        self.waiting: list[np.ndarray] = []
        self.size = 0
        self.keys, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        self.waiting.append(keys)
        self.size += len(keys)
        if self.size >= BUFFER:
            self._merge()

    def _merge(self) -> None:
        if self.waiting:
            keys, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            every = np.union1d(self.keys, keys)
            total = np.zeros(len(every), np.int64)
            total[np.searchsorted(every, self.keys)] += self.counts
            total[np.searchsorted(every, keys)] += counts
            self.keys, self.counts = every, total
            self.waiting, self.size = [], 0

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        return self.keys, self.counts


def lookup(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of `wanted` in the sorted `keys`, and whether they are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted
