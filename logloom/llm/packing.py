"""Packing of token sequences by exact complements.

Only the number of pieces of each length matters for the plan, so it is made
from at most ``max_tokens`` counts, however many documents there are. The plan
is a list of patterns (which lengths share a sequence, and how often); pieces
find their place in it by their rank among the pieces of their length.

Null text counts as empty (the closing id alone), a null ``doc_id`` is kept, and
repeated rows are packed like any others. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored, texts
from logloom.llm.tokens import token_ids

#: Groups among which the pieces of one length are numbered, so that a length
#: that very many pieces share is numbered by many tasks.
SALTS = 64

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt int"
PLACED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def _pieces(batches: Iterator[pa.RecordBatch], path: str, max_tokens: int, end_id: int):
    end, width, number = np.array([end_id], "<u4").tobytes(), 4 * max_tokens, 0
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            ids = token_ids(text, path) + end
            for piece, at in enumerate(range(0, len(ids), width)):
                part = ids[at : at + width]
                rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), number % SALTS))
                number += 1
        columns = list(zip(*rows)) or [()] * 6
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["doc_id", "piece", "start", "length", "ids_crc32", "salt"],
        )


def tokenized_pieces(docs: DataFrame, tokenizer: str, max_tokens: int, end_id: int) -> DataFrame:
    """One row per piece; only documents longer than ``max_tokens`` are cut."""
    return texts(docs).mapInArrow(
        functools.partial(_pieces, path=tokenizer, max_tokens=max_tokens, end_id=end_id), PIECES
    )


class _Lengths:
    """Available lengths with indexes of single lengths, pair sums and triple sums.

    ``pairs`` counts the pairs of available lengths for each sum. ``triples`` does so for
    ordered triples, and takes one piece of a length for any number of them: 0 proves
    that no triple has the sum. Both follow each change of availability.
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.size = len(counts) - 1
        self.pairs = np.zeros(self.size + 1, np.int64)
        self.doubles = np.zeros(self.size + 1, np.int64)  # ordered pairs, as ``triples``
        self.triples = np.zeros(self.size + 1, np.int64)
        self.one = np.zeros(self.size + 1, bool)
        self.two = np.zeros(self.size + 1, bool)
        for n in np.flatnonzero(self.left):
            self._mark(n)

    def _mark(self, n: int) -> None:
        """Bring the indexes up to date for length ``n``."""
        one, two, half = self.left[n] > 0, self.left[n] > 1, 2 * n <= self.size
        if one != self.one[n]:
            step = 1 if one else -1
            # (lengths + step * n) to the third and second power, term by term
            self.triples[n:] += 3 * step * self.doubles[: self.size + 1 - n]
            if half:
                self.triples[2 * n :] += 3 * self.one[: self.size + 1 - 2 * n]
                self.doubles[2 * n] += 1
            if 3 * n <= self.size:
                self.triples[3 * n] += step
            self.doubles[n:] += 2 * step * self.one[: self.size + 1 - n]
            self.one[n] = False
            self.pairs[n:] += step * self.one[: self.size + 1 - n]
            self.one[n] = one
        if two != self.two[n]:
            if half:
                self.pairs[2 * n] += 1 if two else -1
            self.two[n] = two

    def take(self, pattern: Counter, times: int) -> None:
        for n, m in pattern.items():
            self.left[n] -= m * times
            self._mark(n)

    def free(self, n: int, taken: Counter) -> bool:
        return self.left[n] > taken[n]

    def largest(self, most: int, taken: Counter) -> int:
        for n in np.flatnonzero(self.one[: most + 1])[::-1]:
            if self.free(n, taken):
                return int(n)
        return 0

    def single(self, gap: int, taken: Counter) -> list[int]:
        return [gap] if self.free(gap, taken) else []

    def pair(self, gap: int, taken: Counter) -> list[int]:
        if not self.pairs[gap]:
            return []
        low = np.arange(1, gap // 2 + 1)
        for a in low[self.one[low] & self.one[gap - low]]:  # the longest partner first
            a, b = int(a), int(gap - a)
            if self.free(b, taken) and self.left[a] > taken[a] + (a == b):
                return [b, a]
        return []

    def triple(self, gap: int, taken: Counter) -> list[int]:
        if not self.triples[gap]:
            return []
        first = np.arange(gap - 2, 0, -1)
        for a in first[self.one[first] & (self.pairs[gap - first] > 0)]:
            a = int(a)
            if self.free(a, taken):
                rest = self.pair(gap - a, taken + Counter([a]))
                if rest:
                    return [a, *rest]
        return []


def packing_plan(counts: np.ndarray) -> list[tuple[Counter, int]]:
    """Patterns and how often each is used; ``counts[n]`` pieces have length n.

    Each sequence starts with the longest piece left. Its gap is closed exactly
    by one, two or three pieces where the indexes know such; else the longest
    piece that fits goes in and the smaller gap is looked up again. A pattern is
    repeated until one of its lengths runs out, so the work depends on the
    number of different lengths.
    """
    lengths, plan, top = _Lengths(counts), [], len(counts) - 1
    longest = top
    while True:
        while longest and not lengths.left[longest]:
            longest -= 1
        if not longest:
            return plan
        taken, gap = Counter([longest]), top - longest
        while gap:
            exact = lengths.single(gap, taken) or lengths.pair(gap, taken) or lengths.triple(gap, taken)
            more = exact or [lengths.largest(gap, taken)]
            if not more[0]:
                break
            taken.update(more)
            gap -= sum(more)
        times = int(min(lengths.left[n] // m for n, m in taken.items()))
        lengths.take(taken, times)
        plan.append((taken, times))


def _intervals(plan: list[tuple[Counter, int]]) -> np.ndarray:
    """For each length and range of ranks: where these pieces go."""
    used, rows, base = Counter(), [], 0
    for pattern, times in plan:
        offset = 0
        for n, m in sorted(pattern.items(), reverse=True):
            rows.append((n, used[n], m, base, offset))
            used[n] += m * times
            offset += n * m
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(batches: Iterator[pa.RecordBatch], intervals, before):
    """Rank among all pieces of the length -> sequence and offset."""
    table, first = intervals.value, before.value
    ends = np.searchsorted(table[:, 0], np.arange(table[:, 0].max(initial=0) + 2)) if len(table) else None
    for batch in batches:
        length = batch["length"].to_numpy()
        rank = first[length, batch["salt"].to_numpy()] + batch["number"].to_numpy() - 1
        row = np.empty(len(rank), np.int64)
        for n in np.unique(length):
            at, lo, hi = length == n, ends[n], ends[n + 1]
            row[at] = lo + np.searchsorted(table[lo:hi, 1], rank[at], "right") - 1
        _, start, many, base, offset = table[row].T
        inside = rank - start
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                pa.array(base + inside // many),
                pa.array(offset + inside % many * length),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def pack_documents(
    docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1
) -> DataFrame:
    """Every piece with its sequence and offset.

    ``docs`` needs ``doc_id`` and ``text``; ``tokenizer`` is the path of a file
    that every executor has. What reaches the driver and is sent back are
    ``max_tokens`` x ``SALTS`` counts at most, and the plan made from them.
    """
    sc = docs.sparkSession.sparkContext
    pieces = stored(tokenized_pieces(docs, tokenizer, max_tokens, end_id), "pieces")
    found = pieces.groupBy("length", "salt").count().toArrow()
    counts = np.zeros((max_tokens + 1, SALTS), np.int64)
    counts[found["length"].to_numpy(), found["salt"].to_numpy()] = found["count"].to_numpy()
    before = sc.broadcast(counts.cumsum(axis=1) - counts)
    intervals = sc.broadcast(_intervals(packing_plan(counts.sum(axis=1))))
    numbered = pieces.withColumn(
        "number",
        F.expr("CAST(row_number() OVER (PARTITION BY length, salt ORDER BY doc_id, piece) AS BIGINT)"),
    )
    return numbered.mapInArrow(functools.partial(_place, intervals=intervals, before=before), PLACED)
