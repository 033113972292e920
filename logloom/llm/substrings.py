"""Removal of long repeated passages by a compacted De Bruijn graph.

The ``size`` words of a window are an edge from its first to its last
``size - 1`` words. Edges that stand in several documents form the graph; edges
that follow each other without a branch, and have the same first document, are
compacted into one path by joins. Runs of a path in a document are its source
coordinates; a run is removed where the path stands in an earlier document.

Most windows stand once, and never become edges: each window has a minimizer
(the least hash of its inner word 5-grams), windows next to each other share it
and form a stretch, and only stretches whose minimizer stands in two documents are
looked at again. Equal windows have equal minimizers, so nothing repeated is missed.
Where all stretches of a minimizer have the same words, their windows stand in the
same documents, and the stretch is one edge of the graph; else each window is one.
Stretches and windows are told apart by cryptographic digests of their words; fast
hashes, for which collisions can be made, only choose minimizers and name nodes.

Null texts have no words. Documents with a null ``doc_id`` are not compared and
lose nothing; rows that repeat a doc_id belong to one document, so they don't
remove each other. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import connected_components
from logloom.llm.store import kept, stored, texts
from logloom.llm.words import Words, slices, window_hashes
from logloom.shared import delete_folder

SIZE = 13
GRAM = 5


def _runs(words: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows with one minimizer in a row: (minimizer, first, end)."""
    grams = window_hashes(words, gram)
    least = np.lib.stride_tricks.sliding_window_view(grams, size - gram + 1).min(1)
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return least[first], first, np.r_[first[1:], len(least)]


def _minimizers(batches: Iterator[pa.RecordBatch], size: int, gram: int):
    """Minimizers of each document, with a digest of their stretches' words."""
    for batch in slices(batches):
        words = Words(batch["text"])
        hashes, (joined, start, end) = words.hashes(), words.joined()
        out = []
        for doc_id, lo, hi in zip(batch["doc_id"].to_pylist(), words.bounds[:-1], words.bounds[1:]):
            if hi - lo >= size and doc_id is not None:
                least, first, last = _runs(hashes[lo:hi], size, gram)
                kinds = _digests(joined, start[lo + first], end[lo + last + size - 2], 8)
                out.append((least.view(np.int64), kinds[:, 0], np.full(len(least), doc_id)))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64)] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["m", "kind", "doc_id"])


def _digests(joined: bytes, start: np.ndarray, end: np.ndarray, size: int = 16) -> np.ndarray:
    """A digest of the bytes from each start to its end, as 64-bit parts."""
    digest = functools.partial(hashlib.blake2b, digest_size=size)
    parts = [digest(joined[a:b]).digest() for a, b in zip(start.tolist(), end.tolist())]
    return np.frombuffer(b"".join(parts), np.int64).reshape(-1, size // 8)


def _edges(batches: Iterator[pa.RecordBatch], size: int, gram: int):
    """Stretches of the given minimizers as edges between their ends, whole or window by window."""
    signed = lambda x: pa.array(x.view(np.int64))
    for batch in slices(batches):
        words = Words(batch["text"])
        hashes, (joined, start, end) = words.hashes(), words.joined()
        out = []
        shared, whole = batch["shared"].to_pylist(), batch["whole"].to_pylist()
        for doc_id, ms, one, lo, hi in zip(batch["doc_id"].to_pylist(), shared, whole, words.bounds[:-1], words.bounds[1:]):
            if hi - lo < size:
                continue
            least, first, last = _runs(hashes[lo:hi], size, gram)
            ends = window_hashes(hashes[lo:hi], size - 1)
            least = least.view(np.int64)
            once = np.isin(least, np.array(one, np.int64))
            many = np.flatnonzero(np.isin(least, np.array(ms, np.int64)) & ~once)
            spans = [np.arange(a, b) for a, b in zip(first[many].tolist(), last[many].tolist())]
            at = np.concatenate([first[once], *spans])
            n = np.concatenate([(last - first)[once], np.ones(len(at) - int(once.sum()), np.int64)])
            halves = _digests(joined, start[lo + at], end[lo + at + n + size - 2])
            out.append((halves[:, 0], halves[:, 1], ends[at], ends[at + n], np.full(len(at), doc_id, np.int64), at, n))
        columns = [np.concatenate(c) for c in zip(*out)] or [np.zeros(0, np.int64)] * 7
        yield pa.RecordBatch.from_arrays(
            [*map(signed, columns[:5]), *(pa.array(c.astype(np.int32)) for c in columns[5:])],
            ["h", "check", "u", "v", "doc_id", "at", "n"],
        )


def repeated_spans(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc_id, path, lo, hi, first_doc): words [lo, hi) of ``doc_id`` lie in
    windows of one compacted path that stands in ``first_doc`` before."""
    spark = docs.sparkSession
    whole = texts(docs).where("doc_id IS NOT NULL")
    runs = whole.mapInArrow(functools.partial(_minimizers, size=size, gram=gram), "m bigint, kind bigint, doc_id bigint")
    of = "OVER (PARTITION BY m)"
    shared, shared_at = kept(
        runs.selectExpr("m", "doc_id", f"min(doc_id) {of} < max(doc_id) {of} AS shared", f"min(kind) {of} = max(kind) {of} AS whole")
        .where("shared").drop("shared"),
        "minimizers",
    )
    marks = shared.groupBy("doc_id").agg(
        F.collect_set("m").alias("shared"), F.collect_set(F.expr("IF(whole, m, NULL)")).alias("whole")
    )
    occurrences, occurrences_at = kept(
        whole.join(marks, "doc_id").select("doc_id", "text", "shared", "whole").mapInArrow(
            functools.partial(_edges, size=size, gram=gram),
            "h bigint, check bigint, u bigint, v bigint, doc_id bigint, at int, n int",
        ),
        "windows",
    )
    delete_folder(spark, shared_at)
    edges, edges_at = kept(
        occurrences.groupBy("h", "check")
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"), F.first("u").alias("u"), F.first("v").alias("v"))
        .where("first_doc < last_doc").drop("last_doc"),
        "repeated",
    )
    # a node joins two edges if nothing branches there and both have one first document
    ends = edges.selectExpr("inline(array(struct(v AS node, h, first_doc, 1 AS ins, 0 AS outs), struct(u AS node, h, first_doc, 0 AS ins, 1 AS outs)))")
    links = (
        ends.groupBy("node")
        .agg(F.sum("ins").alias("ins"), F.sum("outs").alias("outs"), F.min("h").alias("a"), F.max("h").alias("b"),
             F.min("first_doc").alias("x"), F.max("first_doc").alias("y"))
        .where("ins = 1 AND outs = 1 AND x = y AND a != b").select("a", "b")
    )
    paths = connected_components(links).select(F.col("node").alias("h"), F.col("root").alias("path"))
    compacted, compacted_at = kept(
        edges.join(paths, "h", "left").select("h", "check", "first_doc", F.coalesce("path", "h").alias("path")), "paths"
    )
    delete_folder(spark, edges_at)
    placed = occurrences.join(compacted, ["h", "check"]).where("first_doc < doc_id")
    # places on one path that follow each other without a gap are one run
    of = "OVER (PARTITION BY doc_id, path, first_doc ORDER BY at, n ROWS BETWEEN UNBOUNDED PRECEDING AND"
    spans = stored(
        placed.selectExpr("doc_id", "path", "first_doc", "at", "n", f"at <= max(at + n) {of} 1 PRECEDING) AS joins")
        .selectExpr("*", f"count_if(joins IS NOT TRUE) {of} CURRENT ROW) AS run")
        .groupBy("doc_id", "path", "first_doc", "run")
        .agg(F.min("at").alias("lo"), (F.max(F.expr("at + n")) + (size - 1)).alias("hi"))
        .drop("run"),
        "spans",
    )
    delete_folder(spark, occurrences_at)
    delete_folder(spark, compacted_at)
    return spans


def _cut(batches: Iterator[pa.RecordBatch]):
    for batch in slices(batches):
        words = Words(batch["text"])
        joined, start, end = words.joined()
        rows = []
        for spans, lo, hi in zip(batch["spans"].to_pylist(), words.bounds[:-1], words.bounds[1:]):
            keep = np.ones(hi - lo, bool)
            for s in spans or ():
                keep[s["lo"] : s["hi"]] = False
            edges = np.flatnonzero(np.diff(np.r_[False, keep, False].astype(np.int8)))
            parts = [joined[start[lo + a] : end[lo + b - 1]] for a, b in zip(edges[::2], edges[1::2])]
            rows.append((hi - lo, int((~keep).sum()), b" ".join(parts).decode()))
        n, removed, kept = zip(*rows)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), one row per row of ``docs``."""
    spans = repeated_spans(docs, size).groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return texts(docs).join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string"
    )
