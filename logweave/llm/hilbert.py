"""Places along a Hilbert curve."""

from __future__ import annotations

import numpy as np


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of grid coordinates below ``2**bits`` on the Hilbert curve; rows x dims, 63 bits in all.

    The coordinates are turned into the transposed index, plane by plane from the top:
    a set bit inverts the lower bits of the first coordinate, a clear one exchanges them with it. Gray
    decoding across the coordinates and interleaving their bits gives the place.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    plane = top
    while plane > 1:
        below = plane - 1
        for d in range(dims):
            high = (x[d] & plane) != 0
            swap = np.where(high, 0, (x[0] ^ x[d]) & below)
            x[0] ^= np.where(high, below, swap)
            x[d] ^= swap
        plane >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    plane = top
    while plane > 1:
        turn ^= np.where((x[dims - 1] & plane) != 0, plane - 1, 0)
        plane >>= 1
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            place = (place << 1) | ((x[d] >> bit) & 1)
    return place
