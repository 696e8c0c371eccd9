"""Hilbert keys of points in a unit cube, many at once."""

from __future__ import annotations

import numpy as np


def keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of coordinates from 0 to 1; rows times bits at most 63.

    Coordinates become `bits`-bit numbers. From the highest bit down, the cell's corner is turned so
    that the curve inside it has standard direction; then the bits, Gray-decoded, are interleaved.
    """
    count, axes = points.shape
    if axes * bits > 63:
        raise ValueError("the key has more than 63 bits")
    x = np.clip((points * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1).T.copy()
    high = 1 << (bits - 1)
    bit = high
    while bit > 1:
        below = bit - 1
        for k in range(axes):
            on = (x[k] & bit) != 0
            swap = np.where(on, 0, (x[0] ^ x[k]) & below)
            x[0] ^= np.where(on, below, swap)
            x[k] ^= swap
        bit >>= 1
    for k in range(1, axes):
        x[k] ^= x[k - 1]
    turn, bit = np.zeros(count, np.int64), high
    while bit > 1:
        turn = np.where(x[-1] & bit, turn ^ (bit - 1), turn)
        bit >>= 1
    x ^= turn
    key = np.zeros(count, np.int64)
    for b in range(bits - 1, -1, -1):
        for k in range(axes):
            key = key << 1 | (x[k] >> b) & 1
    return key
