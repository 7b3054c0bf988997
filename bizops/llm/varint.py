"""Whole numbers from 0 to 2^35 - 1 as bytes of seven bits each, written and read as arrays."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values in turn, and each value's number of bytes."""
    v = np.asarray(values, np.int64)
    widths = 1 + (v >= 1 << 7).astype(np.int64) + (v >= 1 << 14) + (v >= 1 << 21) + (v >= 1 << 28)
    ends = np.cumsum(widths)
    out = np.empty(int(ends[-1]) if len(v) else 0, np.uint8)
    at, left = ends - widths, widths.copy()
    while len(v):
        more = left > 1
        out[at] = (v & 127) | (more.astype(np.int64) << 7)
        v, at, left = v[more] >> 7, at[more] + 1, left[more] - 1
    return out, widths


def decode(data: bytes | np.ndarray) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8) if isinstance(data, (bytes, memoryview)) else data
    if not len(raw):
        return np.zeros(0, np.int64)
    last = raw < 128
    starts = np.flatnonzero(np.r_[True, last[:-1]])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.r_[starts, len(raw)]))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)
