"""Words of whole texts as positions in one byte buffer per Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is a slice of its own.
SLICE = 4 << 20

SOLID = np.ones(256, bool)
SOLID[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``most`` bytes of text."""
    for batch in batches:
        sizes = np.cumsum([len(x) for x in (v.as_py() or "" for v in batch[column])])
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 bounds of each; null is empty."""
    texts = pa.array(texts).fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """``start``, ``end``: byte places of each word in ``data``; words of text i
    are ``bounds[i]`` to ``bounds[i + 1]``."""

    def __init__(self, texts: pa.Array, kinds: np.ndarray = SOLID):
        self.data, self.texts = text_bytes(texts)
        solid = kinds[self.data]
        edge = np.zeros(len(solid) + 1, bool)
        edge[self.texts] = True
        first, last = solid.copy(), solid.copy()
        first[1:] &= ~solid[:-1] | edge[1:-1]
        last[:-1] &= ~solid[1:] | edge[1:-1]
        self.solid = solid
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, self.texts)

    def joined(self, data: np.ndarray | None = None) -> tuple[bytes, np.ndarray, np.ndarray]:
        """The words joined by single spaces within each text, and their places there."""
        data = self.data if data is None else data
        keep = self.solid.copy()
        after = self.end[self.end < len(keep)]
        keep[after] = True  # the white space after a word stays, as a space
        place = np.cumsum(keep) - 1
        out = np.where(self.solid, data, np.uint8(0x20))[keep]
        return out.tobytes(), place[self.start], place[self.end - 1] + 1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes (polynomial, then mixed)."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        # places counted from the text's start would need another array; a word's
        # own polynomial is the difference of prefix sums, scaled back to its start
        n = len(self.data)
        power = np.full(n + 1, _MULTIPLIER, np.uint64)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
        own = (sums[self.end] - sums[self.start]) * power[n - self.start]
        scale = np.uint64(pow(int(_MULTIPLIER), -n, 1 << 64))
        return mixed(own * scale + (self.end - self.start).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads differences over all 64 bits."""
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _MULTIPLIER
    return x ^ (x >> np.uint64(32))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes; windows may cross texts."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(size):
        out = out * _MULTIPLIER + words[k : k + count]
    return mixed(out)
