"""Elias-Fano codes of non-decreasing integers, with a select directory.

Each value keeps its low ``l`` bits verbatim and its high part in unary: the
i-th one of the upper bit vector stands at ``(value >> l) + i``.  That takes
about ``2 + log2(last / n)`` bits a value.  ``select`` starts at the nearest
place of a sampled directory (32 bits for every ``SAMPLE`` values) and counts
ones byte by byte from there, so no table of values or ranks is made.
"""

from __future__ import annotations

import struct

import numpy as np

#: One directory entry for this many ones.
SAMPLE = 64
HEAD = struct.Struct("<QBQQQ")   # values, low bits, bytes of low, high, directory
ONES = np.array([b.bit_count() for b in range(256)], np.int64)
LOWEST = np.array([(b & -b).bit_length() - 1 for b in range(256)], np.int64)


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.directory = n, low_bits, low, high, directory

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        v = np.asarray(values, np.uint64)
        n = len(v)
        last = int(v[-1]) if n else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = np.packbits(((v[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        bits[ones] = 1
        return cls(n, low_bits, low, np.packbits(bits, bitorder="little"), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        parts = self.low.tobytes(), self.high.tobytes(), self.directory.tobytes()
        return HEAD.pack(self.n, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple["EliasFano", int]:
        """The code at the start of ``data`` and how many bytes it takes."""
        n, low_bits, a, b, c = HEAD.unpack_from(data)
        at = HEAD.size
        low = np.frombuffer(data, np.uint8, a, at)
        high = np.frombuffer(data, np.uint8, b, at + a)
        directory = np.frombuffer(data, "<u4", c // 4, at + a + b)
        return cls(n, low_bits, low, high, directory), at + a + b + c

    def select(self, index) -> np.ndarray:
        """The values at the given positions."""
        i = np.atleast_1d(np.asarray(index, np.int64))
        at = self.directory[i // SAMPLE].astype(np.int64)
        byte, still = at >> 3, i % SAMPLE                # ones to pass from the sampled one on
        bits = self.high[byte] & (np.uint8(0xFF) << (at & 7).astype(np.uint8))
        todo = np.arange(len(i))
        while len(todo := todo[still[todo] >= ONES[bits[todo]]]):
            still[todo] -= ONES[bits[todo]]
            byte[todo] += 1
            bits[todo] = self.high[byte[todo]]
        # the wanted one is in ``bits``: drop the ones before it
        for _ in range(7):
            more = still > 0
            bits[more] &= bits[more] - np.uint8(1)
            still[more] -= 1
        upper = byte * 8 + LOWEST[bits] - i
        value = upper.astype(np.uint64) << np.uint64(self.low_bits)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            value |= ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return value.astype(np.int64)
