"""Runs of bytes of one class, for operators whose words are not bounded by white space."""

from __future__ import annotations

import numpy as np


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    """A table of the bytes within the spans (both ends included)."""
    table = np.zeros(256, np.bool_)
    for low, high in spans:
        table[low : high + 1] = True
    return table


#: Every byte of a non-ASCII character is at least 0x80, so byte classes hold for whole characters.
LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
LOWER_OR_DIGIT = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def runs(solid: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut at texts' ends, and each text's first run (n + 1 long)."""
    if not len(solid):
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(solid))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets)
