"""Near-duplicates by SimHash and tables of pivot distances.

A fingerprint's Hamming distances to fixed reference fingerprints (pivots) are
its coordinates, and coordinates of two fingerprints differ by no more than
their own distance. Pivots come in blocks: those of a block differ from zero in
its bits only and are compared there, so the largest coordinate differences of
all blocks add up to at most the fingerprints' distance. With ``BLOCKS`` blocks
and a distance of at most ``most`` < BLOCKS, the difference is zero in
``BLOCKS - most`` blocks: fingerprints meet by equal coordinates there. Pairs
that meet are discarded by the largest difference over further pivots of all 64
bits, and survivors are verified. No pair within the distance is lost.

Equal fingerprints are one node, so copies never meet in pairs. A bucket of more
than ``TILE`` fingerprints is worked on tile pair by tile pair, in many tasks, and
each gives back a forest of its links instead of all pairs.

A null text counts as empty: fingerprint zero, linked like any other. Rows with
a null ``doc_id`` take part; a group of such alone has a null ``component_id``.
Repeated rows come out as often as they go in.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import connected_components
from logloom.llm.store import stored, texts
from logloom.llm.words import LOWER, Words, slices

BLOCKS = 6
BLOCK_PIVOTS = 8
PIVOTS = 16
TILE = 2048
#: Hashes whose bits are counted at once.
BITS_AT_ONCE = 1 << 17


def _simhash(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        bits = np.unpackbits(hashes[at : at + BITS_AT_ONCE].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int):
    hash_of = xxhash.xxh64_intdigest
    for batch in slices(batches):
        words = Words(batch["text"])
        joined, start, end = words.joined(LOWER[words.data])
        out = np.zeros(batch.num_rows, np.int64)
        for n, (lo, hi) in enumerate(zip(words.bounds[:-1], words.bounds[1:])):
            if hi > lo:
                size = min(shingle, hi - lo)
                spans = zip(start[lo : hi - size + 1].tolist(), end[lo + size - 1 : hi].tolist())
                hashes = np.fromiter((hash_of(joined[a:b], 42) for a, b in spans), np.uint64, hi - lo - size + 1)
                out[n] = _simhash(hashes)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out)], ["doc_id", "fp"])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of each whole text as a signed number."""
    return texts(docs).mapInArrow(functools.partial(_fingerprints, shingle=shingle), "doc_id bigint, fp bigint")


def _masks() -> list[int]:
    bounds = [round(64 * k / BLOCKS) for k in range(BLOCKS + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(bounds, bounds[1:])]


@functools.cache
def _pivots() -> tuple[list[list[int]], np.ndarray]:
    """Pivots of each block, and those of all bits; fixed by rule."""
    word = lambda n: xxhash.xxh64_intdigest(str(n).encode(), 7)
    blocks = [[word(b * BLOCK_PIVOTS + k) & mask for k in range(BLOCK_PIVOTS)] for b, mask in enumerate(_masks())]
    return blocks, np.array([word(10_000 + k) for k in range(PIVOTS)], np.uint64)


def _signed(x: int) -> str:
    """A 64-bit pattern as SQL text (the least number has no literal of its own)."""
    x = x - (1 << 64) if x >> 63 else x
    return f"({x + 1}L - 1L)" if x < 0 else f"{x}L"


def _coordinates(block: int) -> str:
    """The block's pivot distances, four bits each, in one number."""
    mask, pivots = _masks()[block], _pivots()[0][block]
    return " | ".join(
        f"shiftleft(CAST(bit_count((fp & {_signed(mask)}) ^ {_signed(p)}) AS BIGINT), {4 * k})" for k, p in enumerate(pivots)
    )


def _forest(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a[left], b[right]) as (node, least node reachable) in this tile."""
    nodes, where = np.unique(np.concatenate([a[left], b[right]]), return_inverse=True)
    x, y, label = where[: len(left)], where[len(left) :], np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            moved = label != np.arange(len(nodes))
            return nodes[moved], nodes[label[moved]]
        label = new


def _tile_links(batches: Iterator[pa.RecordBatch], most: int):
    """Links of each tile pair, as a forest."""
    pivots = _pivots()[1]
    at_pivots = lambda x: np.bitwise_count(x[:, None] ^ pivots).astype(np.int8)
    for batch in batches:
        found = [(np.zeros(0, np.int64),) * 2]
        for left, right in zip(batch["lefts"], batch["rights"]):
            a = left.values.to_numpy()
            b = right.values.to_numpy() if right.is_valid and len(right.values) else a
            ua, ub = a.view(np.uint64), b.view(np.uint64)
            ca, cb = at_pivots(ua), at_pivots(ub)
            near = np.ones((len(a), len(b)), bool) if b is not a else np.triu(np.ones((len(a), len(a)), bool), 1)
            for k in range(PIVOTS):  # the largest coordinate difference
                near &= np.abs(ca[:, k, None] - cb[None, :, k]) <= most
            i, j = np.nonzero(near)
            close = np.bitwise_count(ua[i] ^ ub[j]) <= most
            if close.any():
                found.append(_forest(i[close], j[close], a, b))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["a", "b"])


def fingerprint_links(nodes: DataFrame, most: int = 4) -> DataFrame:
    """Edges (a, b) that connect the fingerprints ``fp`` of ``nodes`` (each once)
    just as all pairs at most ``most`` bits apart do."""
    if not 0 <= most < BLOCKS:
        raise ValueError(f"most must be 0 to {BLOCKS - 1}")
    blocks = ", ".join(f"{_coordinates(b)} AS c{b}" for b in range(BLOCKS))
    tables = ", ".join(
        f"named_struct('t', {t}, 'k', xxhash64({', '.join(f'c{b}' for b in own)}))"
        for t, own in enumerate(combinations(range(BLOCKS), BLOCKS - most))
    )
    entries = nodes.selectExpr("fp", *(f"{_coordinates(b)} AS c{b}" for b in range(BLOCKS)))
    entries = entries.selectExpr("fp", f"inline(array({tables}))")
    tiles = entries.selectExpr(
        "t", "k", "fp",
        "count(*) OVER (PARTITION BY t, k) AS n",
        f"CAST((row_number() OVER (PARTITION BY t, k ORDER BY fp) - 1) DIV {TILE} AS INT) AS tile",
    ).where("n > 1")
    meeting = tiles.selectExpr(
        "t", "k", "fp", "tile", f"explode(sequence(0, CAST((n - 1) DIV {TILE} AS INT))) AS other"
    )
    pairs = meeting.groupBy("t", "k", F.expr("least(tile, other)").alias("x"), F.expr("greatest(tile, other)").alias("y")).agg(
        F.expr("collect_list(fp) FILTER (WHERE tile = least(tile, other) )").alias("lefts"),
        F.expr("collect_list(fp) FILTER (WHERE tile != least(tile, other))").alias("rights"),
    )
    return pairs.select("lefts", "rights").mapInArrow(functools.partial(_tile_links, most=most), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, most: int = 4, shingle: int = 4) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``."""
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(fingerprint_links(nodes, most)).select(F.col("node").alias("fp"), "root")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.expr("coalesce(root, fp)"))
    placed = stored(placed, "nodes")
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = placed.join(named, "root").select("fp", "component_id")
    return marked.join(groups, "fp").select("doc_id", "fp", "component_id")


def without_near_duplicates(docs: DataFrame, most: int = 4, shingle: int = 4) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its group.

    A row with a null ``doc_id`` can't be compared by name; it is kept.
    """
    kept = near_duplicates(docs, most, shingle).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
