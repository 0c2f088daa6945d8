"""Places on a Hilbert curve, for many points at once."""

from __future__ import annotations

import numpy as np


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """The place of each point on the curve through a cube of 2^bits cells a side.

    ``points`` is (n, dimensions) of unsigned integers below 2^bits.  The coordinates are turned
    into the transposed index by exchanging and inverting low bits from the top bit down, Gray
    coded, and interleaved.
    """
    n, dims = points.shape
    if dims * bits > 62:
        raise ValueError("a key has 62 bits at most")
    x = [points[:, i].astype(np.uint64) for i in range(dims)]
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        low = bit - np.uint64(1)
        for i in range(dims):
            on = (x[i] & bit) != 0
            flip = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ flip)
            if i:
                x[i] = x[i] ^ flip
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(n, dtype=np.uint64)
    for level in range(bits - 1, 0, -1):
        bit = np.uint64(1 << level)
        turn = np.where((x[dims - 1] & bit) != 0, turn ^ (bit - np.uint64(1)), turn)
    x = [v ^ turn for v in x]
    key = np.zeros(n, dtype=np.uint64)
    for level in range(bits - 1, -1, -1):
        for v in x:
            key = (key << np.uint64(1)) | ((v >> np.uint64(level)) & np.uint64(1))
    return key.astype(np.int64)


def cells(values: np.ndarray, low: float, high: float, bits: int) -> np.ndarray:
    """Cell numbers of coordinates; values beyond the span fall into the outer cells."""
    scaled = (values - low) / (high - low) * (1 << bits)
    return np.clip(np.floor(scaled), 0, (1 << bits) - 1).astype(np.uint64)
