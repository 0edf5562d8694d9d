"""Places of points along a Hilbert curve, for many points at once (Skilling's transform)."""

import numpy as np


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (points x axes, whole numbers below 2**bits) on the curve.

    axes * bits must not exceed 62.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    top = np.int64(1) << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(axes):
            inverted = (x[i] & q) != 0
            swap = np.where(inverted, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inverted, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key
