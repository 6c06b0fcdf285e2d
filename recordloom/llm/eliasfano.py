"""Elias-Fano codes of non-decreasing integers, with a select structure.

A value's lowest bits are packed side by side; its upper part is a gap in a bit vector, in which the i-th one stands at
upper(i) + i.  That takes 2 + log2(universe / n) bits a value.  Every ``EVERY``-th one's place is sampled, as 32 bits,
so that the i-th value is found by reading a few words.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<4sBQQQQ")
_MAGIC = b"EFv1"
EVERY = 256


def encode(values: np.ndarray) -> bytes:
    """The code of non-decreasing integers from 0 on."""
    v = np.asarray(values, np.uint64)
    n, top = len(v), int(v[-1]) + 1 if len(v) else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    lower = np.packbits(bits.ravel(), bitorder="little").tobytes()
    places = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
    if n and places[-1] >= 1 << 32:
        raise ValueError("a code holds fewer than 2**32 bits; use smaller shards")
    upper = np.zeros((int(places[-1]) + 64) // 64 * 64 if n else 0, np.uint8)
    upper[places] = 1
    upper = np.packbits(upper, bitorder="little").tobytes()
    samples = places[::EVERY].astype("<u4").tobytes()
    return _HEAD.pack(_MAGIC, low, n, top, len(lower), len(upper)) + lower + upper + samples


class EliasFano:
    def __init__(self, data: bytes):
        magic, self.low, self.n, self.top, n_lower, n_upper = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not an Elias-Fano code")
        at = _HEAD.size
        self.lower = np.frombuffer(data, np.uint8, n_lower, at)
        self.upper = np.frombuffer(data, np.uint8, n_upper, at + n_lower)
        self.samples = np.frombuffer(data, "<u4", -(-self.n // EVERY), at + n_lower + n_upper)
        self.size = at + n_lower + n_upper + len(self.samples) * 4

    def __len__(self) -> int:
        return self.n

    def range(self, start: int, stop: int) -> np.ndarray:
        """Values start..stop-1, by select on the samples around them."""
        if not 0 <= start <= stop <= self.n:
            raise IndexError((start, stop))
        if start == stop:
            return np.empty(0, np.int64)
        s, e = start // EVERY, -(-stop // EVERY)
        first = int(self.samples[s]) // 8
        last = int(self.samples[e]) // 8 + 1 if e < len(self.samples) else len(self.upper)
        ones = np.flatnonzero(np.unpackbits(self.upper[first:last], bitorder="little")) + first * 8
        ones = ones[np.searchsorted(ones, self.samples[s]) :][start - s * EVERY : stop - s * EVERY]
        i = np.arange(start, stop)
        values = (ones - i) << self.low
        if self.low:
            b0 = start * self.low // 8
            bits = np.unpackbits(self.lower[b0 : -(-stop * self.low // 8)], bitorder="little")[start * self.low - b0 * 8 :]
            bits = bits[: (stop - start) * self.low].reshape(-1, self.low).astype(np.int64)
            values = values + (bits << np.arange(self.low)).sum(axis=1)
        return values

    def __getitem__(self, i: int) -> int:
        return int(self.range(i, i + 1)[0])
