"""Elias-Fano coding of a non-decreasing sequence: about 2 + log2(universe / n) bits a value.

The low bits of all values stand packed one after another; the high parts are a unary bit vector in
which the i-th set bit, minus i, is the high part of value i.  Sampled positions of every
``SAMPLE``-th set bit let :meth:`EliasFano.get` find one value by scanning a few bytes.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEADER = struct.Struct("<QQBQQQ")  # n, smallest value, low bits, bytes of: low, high, samples
POPCOUNT = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)


class EliasFano:
    def __init__(self, n: int, base: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.base, self.low_bits = n, base, low_bits
        self.low = np.frombuffer(low, np.uint8)
        self.high = np.frombuffer(high, np.uint8)
        self.samples = samples

    @classmethod
    def build(cls, values) -> "EliasFano":
        v = np.asarray(values, np.int64)
        n = len(v)
        if n == 0:
            return cls(0, 0, 0, b"", b"", np.zeros(0, np.uint32))
        if (v[1:] < v[:-1]).any():
            raise ValueError("values must not decrease")
        base = int(v[0])
        rel = v.astype(np.uint64) - np.uint64(base & 0xFFFFFFFFFFFFFFFF)
        span = int(rel[-1]) + 1
        bits = max(0, (span // n).bit_length() - 1)
        lows = (rel[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        ones = (rel >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        kind = np.uint32 if ones[-1] < 1 << 32 else np.uint64
        return cls(n, base, bits, np.packbits(lows.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(high, bitorder="little").tobytes(), ones[::SAMPLE].astype(kind))

    def to_bytes(self) -> bytes:
        parts = self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()
        return HEADER.pack(self.n, self.base & 0xFFFFFFFFFFFFFFFF, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, base, bits, a, b, c = HEADER.unpack_from(data)
        at = HEADER.size
        samples = data[at + a + b:at + a + b + c]
        kind = np.uint32 if c == 4 * -(-n // SAMPLE) else np.uint64
        base -= (1 << 64) if base >> 63 else 0
        return cls(n, base, bits, data[at:at + a], data[at + a:at + a + b], np.frombuffer(samples, kind))

    def _low(self, i: int) -> int:
        value = 0
        for j in range(self.low_bits):
            bit = i * self.low_bits + j
            value |= (int(self.low[bit >> 3]) >> (bit & 7) & 1) << j
        return value

    def select(self, i: int) -> int:
        """Position of the i-th set bit of the high vector."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, word = at >> 3, int(self.high[at >> 3]) >> (at & 7) << (at & 7)
        while (count := int(POPCOUNT[word])) <= left:
            left -= count
            byte += 1
            word = int(self.high[byte])
        for bit in range(8):
            if word >> bit & 1:
                if left == 0:
                    return byte * 8 + bit
                left -= 1
        raise IndexError(i)

    def get(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        return self.base + ((self.select(i) - i) << self.low_bits | self._low(i))

    def decode(self) -> np.ndarray:
        """All values at once."""
        if self.n == 0:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        value = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits]
            weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
            value |= (bits.reshape(self.n, self.low_bits).astype(np.uint64) * weights).sum(1, dtype=np.uint64)
        return (value + np.uint64(self.base & 0xFFFFFFFFFFFFFFFF)).astype(np.int64)
