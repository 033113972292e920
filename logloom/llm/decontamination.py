"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document holds a benchmark item where a window of as many words as the item
has is at most ``1 - least`` of them edits away (words: runs of letters and
digits, lower-cased). Windows are found in three steps.

1. Anchors. An item of n words with e edits keeps an unbroken run of at least
   ceil((n - e) / (e + 1)) of its words, so a window without such a run in common
   is not near. This is exact, and leaves few places.
2. The windows around an anchor, shifted by up to e words, are embedded by the
   CGK random walk: it reads 3n symbols and steps on or stays by a random bit of
   step and symbol, which turns edits into few Hamming differences. ``repeats``
   samples of ``BITS`` places each are compared with the item's. For a Hamming
   share of up to ``DIFFER`` a window agrees with its item in one of them with
   probability ``recall``, which fixes the number of samples.
3. Agreeing windows are verified by their exact edit distance.

Items shorter than ``SHORTEST`` words have no unbroken run to search for and are
not searched. Null texts hold nothing; documents or items with null ids take
part under that id; repeated rows give repeated results. The items are sent to
all tasks, and are refused above ``MOST_WORDS`` words.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import texts
from logloom.llm.words import Words, mixed, slices, window_hashes

BITS = 2
#: Random walks that the samples are shared among, so that they are independent.
WALKS = 8
DIFFER = 0.7
#: Multiplier whose highest product bit is the walk's coin; words are mixed hashes already.
COIN = np.uint64(0xD1342543DE82EF95)
RECALL = 0.99
SHORTEST = 5
MOST_WORDS = 4_000_000

ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def _lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes and each text's bounds, letters and digits only."""
    words = Words(pc.utf8_lower(pa.array(column).fill_null("").cast(pa.large_string())), ALNUM)
    return words.hashes(), words.bounds


def _edits(n: int, least: float) -> int:
    return int(n * (1 - least) + 1e-9)


def _embed(windows: np.ndarray, seed: int) -> np.ndarray:
    """CGK: rows of n word hashes -> rows of 3n symbols; 0 pads behind the end."""
    rows, n = windows.shape
    padded = np.c_[windows, np.zeros(rows, np.uint64)]
    at, every = np.zeros(rows, np.int64), np.arange(rows)
    out = np.empty((rows, 3 * n), np.uint64)
    for step in range(3 * n):
        symbol = padded[every, at]
        out[:, step] = symbol
        salt = np.uint64((step * 2 + 1) * 0x9E3779B97F4A7C15 + seed * 0xD6E8FEB86659FD93 & 0xFFFF_FFFF_FFFF_FFFF)
        coin = (symbol ^ salt) * COIN >> np.uint64(63)
        at = np.minimum(at + coin.astype(np.int64), n)
    return out


def _repeats(recall: float) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - DIFFER) ** BITS))


def _places(n: int, repeat: int) -> np.ndarray:
    seeds = np.arange(BITS, dtype=np.uint64) + np.uint64(1 + BITS * repeat)
    return (mixed(seeds) % np.uint64(2 * n)).astype(np.int64)


def _distance(a: list, b: list, most: int) -> int:
    """Edit distance, or most + 1 if it is more; only the diagonal band counts."""
    far = most + 1
    row = [j if j <= most else far for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        lo, hi = max(1, i - most), min(len(b), i + most)
        new = [far] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(lo, hi + 1):
            new[j] = min(row[j - 1] + (x != b[j - 1]), row[j] + 1, new[j - 1] + 1, far)
        row = new
        if min(row) > most:
            return far
    return row[-1]


class _Items:
    """The benchmark as arrays: anchors by hash, embedded items by size."""

    def __init__(self, rows: list[tuple[int, str]], least: float, recall: float):
        hashes, bounds = _lowered(pa.array([t for _, t in rows], pa.string()))
        self.repeats, self.least = _repeats(recall), least
        self.ids, self.words, grams = [], [], defaultdict(list)
        for (item, _), lo, hi in zip(rows, bounds[:-1], bounds[1:]):
            n = int(hi - lo)
            if n < SHORTEST:
                continue
            number, e = len(self.ids), _edits(n, least)
            self.ids.append(item)
            self.words.append(hashes[lo:hi])
            run = math.ceil((n - e) / (e + 1))
            for at, h in enumerate(window_hashes(hashes[lo:hi], run).tolist()):
                grams[run].append((h, number, at))
        self.anchors = {}
        for run, found in grams.items():
            found.sort()
            h, number, at = zip(*found)
            self.anchors[run] = np.array(h, np.uint64), np.array(number), np.array(at)
        sizes, self.embedded = defaultdict(list), [[] for _ in self.words]
        for number, w in enumerate(self.words):
            sizes[len(w)].append(number)
        for numbers in sizes.values():  # items of one size walk together
            together = np.stack([self.words[n] for n in numbers])
            for walk in range(WALKS):
                for n, row in zip(numbers, _embed(together, walk)):
                    self.embedded[n].append(row.copy())

    def search(self, hashes: np.ndarray, bounds: np.ndarray) -> list[tuple]:
        """(text, item, edits, first word, end) of the nearest window of each item in a text."""
        starts = defaultdict(set)
        for run, (known, number, at) in self.anchors.items():
            windows = window_hashes(hashes, run)
            lo = np.searchsorted(known, windows, "left")
            hit = np.flatnonzero(known[np.minimum(lo, len(known) - 1)] == windows)
            for place, first in zip(hit.tolist(), lo[hit].tolist()):
                text = int(np.searchsorted(bounds, place, "right")) - 1
                end = first
                while end < len(known) and known[end] == windows[place]:
                    starts[int(number[end])].add((text, place - int(at[end])))
                    end += 1
        found = {}
        for item, places in starts.items():
            words = self.words[item]
            n, most = len(words), _edits(len(words), self.least)
            todo = {
                (text, max(int(bounds[text]), min(start + shift, int(bounds[text + 1]) - n)))
                for text, start in places
                for shift in range(-most, most + 1)
                if bounds[text + 1] - bounds[text] >= n - most
            }
            todo = np.array(sorted(todo), np.int64).reshape(-1, 2)
            for part in range(0, len(todo), 8192):
                self._verify(item, todo[part : part + 8192], hashes, bounds, found)
        return [(text, self.ids[item], *best) for (text, item), best in sorted(found.items())]

    def _verify(self, item: int, todo: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, found: dict) -> None:
        words = self.words[item]
        n, most = len(words), _edits(len(words), self.least)
        ends = np.minimum(todo[:, 1] + n, bounds[todo[:, 0] + 1])
        place = todo[:, 1:] + np.arange(n)
        windows = np.where(place < ends[:, None], hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0))
        agree = np.zeros(len(todo), bool)
        for walk in range(WALKS):
            rest = np.flatnonzero(~agree)
            same = _embed(windows[rest], walk) == self.embedded[item][walk]
            for repeat in range(walk, self.repeats, WALKS):
                agree[rest] |= same[:, _places(n, repeat)].all(1)
        target = words.tolist()
        for row in np.flatnonzero(agree):
            text, start, end = int(todo[row, 0]), int(todo[row, 1]), int(ends[row])
            best = found.get((text, item))
            limit = most if best is None else best[0] - 1
            if limit >= 0 and (d := _distance(hashes[start:end].tolist(), target, limit)) <= limit:
                found[text, item] = d, start - int(bounds[text]), end - int(bounds[text])


def _search(batches: Iterator[pa.RecordBatch], items):
    known = items.value
    for batch in slices(batches):
        hashes, bounds = _lowered(batch["text"])
        rows = known.search(hashes, bounds) if known.ids and len(hashes) else []
        doc_ids = batch["doc_id"].to_pylist()
        columns = list(zip(*((doc_ids[t], item, edits, lo, hi) for t, item, edits, lo, hi in rows))) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "item_id", "edits", "start", "end"])


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, recall: float = RECALL) -> DataFrame:
    """(doc_id, item_id, edits, start, end): the nearest window of each item that
    a row of ``docs`` holds, in words."""
    items = benchmark.selectExpr("CAST(item_id AS BIGINT) AS item_id", "CAST(text AS STRING) AS text").where("text IS NOT NULL")
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    if words > MOST_WORDS:
        raise ValueError(f"{words} benchmark words, more than {MOST_WORDS}: search parts of the benchmark one after the other")
    rows = [(r.item_id, r.text) for r in items.collect()]
    sent = docs.sparkSession.sparkContext.broadcast(_Items(rows, least, recall))
    return texts(docs).mapInArrow(
        functools.partial(_search, items=sent), "doc_id bigint, item_id bigint, edits int, start int, end int"
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """``docs`` without documents that hold an item. Rows with null ``doc_id`` stay."""
    leaks = benchmark_matches(docs, benchmark, least).select("doc_id").where("doc_id IS NOT NULL").distinct()
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
