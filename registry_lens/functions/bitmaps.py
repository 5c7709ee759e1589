"""Compressed bitmaps over the positions of one container (at most 65,536), in numpy."""

from __future__ import annotations

import numpy as np

#: First byte of a serialised bitmap.
SPARSE, RUNS, DENSE = 0, 1, 2


def encode(positions: np.ndarray, size: int) -> bytes:
    """Sorted distinct positions as the smallest of a position list, a run list and packed bits."""
    pos = np.asarray(positions, dtype=np.int64)
    breaks = np.flatnonzero(np.diff(pos) != 1)
    runs = len(breaks) + (len(pos) > 0)
    cost = {SPARSE: 2 * len(pos), RUNS: 4 * runs, DENSE: (size + 7) // 8}
    kind = min(cost, key=cost.get)
    if kind == SPARSE:
        body = pos.astype("<u2").tobytes()
    elif kind == RUNS:
        first, last = pos[np.r_[0, breaks + 1]], pos[np.r_[breaks, len(pos) - 1]]
        body = np.column_stack((first, last)).astype("<u2").tobytes()
    else:
        bits = np.zeros(size, dtype=bool)
        bits[pos] = True
        body = np.packbits(bits).tobytes()
    return bytes([kind]) + body


def words(data: bytes, size: int) -> np.ndarray:
    """A serialised bitmap as packed bytes of ``size`` bits, ready for AND, OR and AND-NOT."""
    kind, body = data[0], data[1:]
    if kind == DENSE:
        return np.frombuffer(body, dtype=np.uint8)
    if kind == SPARSE:
        bits = np.zeros(size, dtype=bool)
        bits[np.frombuffer(body, dtype="<u2")] = True
    else:
        ends = np.frombuffer(body, dtype="<u2").reshape(-1, 2).astype(np.int64)
        step = np.zeros(size + 1, dtype=np.int32)
        step[ends[:, 0]] += 1
        step[ends[:, 1] + 1] -= 1
        bits = np.cumsum(step[:-1]) > 0
    return np.packbits(bits)


def positions(packed: np.ndarray, size: int) -> np.ndarray:
    """Positions of the set bits."""
    return np.flatnonzero(np.unpackbits(packed, count=size))
