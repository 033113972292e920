"""Elias-Fano coding of non-decreasing numbers, with a select structure."""

from __future__ import annotations

import struct

import numpy as np

#: Every how many numbers the place of the high bit is noted.
SAMPLE = 256

_HEAD = struct.Struct("<QQQB")  # how many, least number, largest less least, low bits


class EliasFano:
    """``n`` non-decreasing numbers in about ``n * (2 + log2(range / n))`` bits.

    A number is taken from the least one; its low bits stand in a packed array,
    its high bits ``h`` as the one at position ``h + i`` of a bit set. ``select``
    finds the i-th one from the nearest noted position and so returns one number
    without unpacking the rest; ``all`` unpacks everything at once.
    """

    def __init__(self, n: int, least: int, span: int, width: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.least, self.span, self.width = n, least, span, width
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        """``numbers``: non-decreasing signed 64-bit integers."""
        numbers = np.ascontiguousarray(numbers, np.int64)
        n = len(numbers)
        if not n:
            return cls(0, 0, 0, 0, b"", b"", b"")
        least = int(numbers[0])
        above = numbers.view(np.uint64) - np.uint64(least & 0xFFFFFFFFFFFFFFFF)
        span = int(above[-1])
        width = max(0, ((span + 1) // n).bit_length() - 1)
        places = (above >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1, np.uint8)
        bits[places] = 1
        digits = (above[:, None] >> np.arange(width, dtype=np.uint64)).astype(np.uint8) & 1
        return cls(
            n, least, span, width,
            np.packbits(digits, bitorder="little").tobytes(),
            np.packbits(bits, bitorder="little").tobytes(),
            places[::SAMPLE].astype("<u4").tobytes(),
        )

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.least & 0xFFFFFFFFFFFFFFFF, self.span, self.width)
        return head + b"".join(struct.pack("<I", len(p)) + p for p in (self.low, self.high, self.samples))

    @classmethod
    def from_bytes(cls, data: bytes) -> EliasFano:
        n, least, span, width = _HEAD.unpack_from(data)
        at, parts = _HEAD.size, []
        for _ in range(3):
            (size,) = struct.unpack_from("<I", data, at)
            parts.append(data[at + 4 : at + 4 + size])
            at += 4 + size
        return cls(n, least - (least >> 63 << 64), span, width, *parts)

    def __len__(self) -> int:
        return self.n

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = (np.flatnonzero(bits) - np.arange(self.n)).astype(np.uint64)
        digits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.width)
        weights = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
        low = digits.reshape(self.n, self.width).astype(np.uint64) @ weights
        above = (high << np.uint64(self.width)) | low
        return (above + np.uint64(self.least & 0xFFFFFFFFFFFFFFFF)).view(np.int64)

    def select(self, i: int) -> int:
        """The number at ``i``, counted from 0."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        noted = struct.unpack_from("<I", self.samples, 4 * (i // SAMPLE))[0]
        left, at = i % SAMPLE, noted // 8
        byte = self.high[at] >> noted % 8 << noted % 8  # ones before the noted one don't count
        while byte.bit_count() <= left:
            left -= byte.bit_count()
            at += 1
            byte = self.high[at]
        for _ in range(left):
            byte &= byte - 1
        place = 8 * at + (byte & -byte).bit_length() - 1
        first, last = i * self.width, (i + 1) * self.width
        low = int.from_bytes(self.low[first // 8 : -(-last // 8)], "little") >> first % 8
        return self.least + ((place - i) << self.width | low & (1 << self.width) - 1)

    def find(self, number: int) -> int:
        """How many numbers are at most ``number``."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            if self.select(middle) <= number:
                low = middle + 1
            else:
                high = middle
        return low
