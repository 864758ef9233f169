"""Vectorised hashes of byte strings, for the operators that work on whole Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x + np.uint64((seed * _BASE + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), 1)


def _powers(n: int, base: int) -> np.ndarray:
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        full = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        full[0] = 1
        known = _POWERS[base] = np.cumprod(full)
    return known[:n]


class Spans:
    """Hashes of any spans of one buffer; equal contents have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * _powers(n, _BASE), out=self.sums[1:])
        self.back = _powers(n + 1, pow(_BASE, -1, 2**64))

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def every(self, length: int) -> np.ndarray:
        """Mixed hashes of all spans of one length."""
        return mix((self.sums[length:] - self.sums[:-length]) * self.back[: len(self.sums) - length])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its n + 1 offsets; nulls are empty."""
    column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = column.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if len(wide) == 0 or wide.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(wide) + 1, dtype=np.int64)
    data = np.frombuffer(wide.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]
