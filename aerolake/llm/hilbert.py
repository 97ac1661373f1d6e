"""Keys along a Hilbert curve for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The position on the curve of each row of ``cells`` (points, dimensions), whole numbers
    of ``bits`` bits; dimensions times bits is at most 63.

    Working down from the highest bit, each bit of each axis either mirrors the lower
    bits of the first axis or swaps them with that axis's; a Gray code over all axes then
    gives the digits of the key.
    """
    x = np.array(cells, np.int64).T.copy()
    dims = len(x)
    for q in range(bits - 1, 0, -1):
        low = (1 << q) - 1
        for i in range(dims):
            high = (x[i] >> q) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for q in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> q) & 1 == 1, (1 << q) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for q in range(bits - 1, -1, -1):
        for i in range(dims):
            key = key << 1 | (x[i] >> q) & 1
    return key
