"""Token ids of a corpus as one long array with Elias-Fano boundaries.

The ids of all documents, in ascending ``doc_id`` order (null first; rows of one
``doc_id`` by a hash of their text, then by text) and each closed by an end id,
form one array. It is
stored as Parquet in two tables below a folder:

* ``blocks``: consecutive whole documents, of ``BLOCK_IDS`` ids or one longer
  document: ``ids`` (little-endian unsigned 32-bit), ``ends`` (where each document ends
  in the block) and ``doc_ids`` (of those that have one; the first ``nulls`` have
  none), both Elias-Fano coded, the block's ``shard`` and ``number``, the ``first``
  id's place in the shard, and ``least_id`` and ``largest_id``, by which a reader
  of some documents skips blocks.
* ``shards``: where each shard starts in the whole array. One row per partition
  of the writing job.

A block can be read alone, so reading shuffles nothing and a task holds one
block. Both tables are committed by Spark's writers, so lost executors leave no
partial files, and any storage that Spark reaches will do.

Null and empty texts give the end id alone. Repeated rows are stored as often as
they occur. Other columns are ignored. An empty table gives empty tables.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm.eliasfano import EliasFano
from logloom.llm.store import texts
from logloom.llm.tokens import token_ids

#: A block is closed by the document that brings it to this many ids or documents.
BLOCK_IDS = 1 << 17
BLOCK_DOCS = 1 << 16
#: Bytes of blocks that a writing or reading task holds at once (a Parquet row group).
GROUP_BYTES = 1 << 22
#: Without the second option, Parquet's writer looks at its sizes only after 100 rows.
GROUPS = {"parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
#: Bytes of texts that a Python worker is given at once.
BATCH_BYTES = 1 << 22

BLOCKS = (
    "shard int, number int, first bigint, n_docs bigint, n_ids bigint, nulls bigint,"
    " least_id bigint, largest_id bigint, ids binary, ends binary, doc_ids binary"
)
SHARDS = "shard int, start bigint, n_docs bigint, n_ids bigint"
DOCUMENTS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"
_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(",")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)], [name for name, _ in fields]
    )


def _blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int, block_ids: int):
    """Blocks of one partition's documents, which come in order."""
    shard, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
    ids, ends, keys, place, first, number = [], [], [], 0, 0, 0

    def closed():
        known = [k for k in keys if k is not None]
        row = (
            shard, number, first, len(keys), place - first, len(keys) - len(known),
            min(known, default=None), max(known, default=None), b"".join(ids),
            EliasFano.of(np.array(ends, np.int64)).to_bytes(), EliasFano.of(np.array(known, np.int64)).to_bytes(),
        )
        return _batch([row], BLOCKS)

    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
            part = token_ids(text.as_py(), path) + end
            place += len(part) // 4
            ids.append(part)
            ends.append(place - first)
            keys.append(doc_id)
            if place - first >= block_ids or len(keys) >= BLOCK_DOCS:
                yield closed()
                ids, ends, keys, first, number = [], [], [], place, number + 1
    if keys:
        yield closed()


@contextlib.contextmanager
def _batch_bytes(spark: SparkSession, size: int):
    """Smaller batches for Python while a job runs."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_token_ids(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = BLOCK_IDS
) -> None:
    """Write the ids of ``docs`` (``doc_id``, ``text``) to the new folder ``path``.

    One shuffle sorts the texts. A hash of the text parts documents that share
    a ``doc_id``, or have none, over several partitions.
    """
    spark = docs.sparkSession
    keyed = texts(docs).withColumn("h", F.expr("xxhash64(text)"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    make = functools.partial(_blocks, path=tokenizer, end_id=end_id, block_ids=block_ids)
    blocks = ordered.select("doc_id", "text").mapInArrow(make, BLOCKS)
    with _batch_bytes(spark, BATCH_BYTES):
        blocks.write.options(**GROUPS).parquet(f"{path}/blocks")
    totals = _read(spark, path, "blocks", BLOCKS).groupBy("shard").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_ids").alias("n_ids")
    )
    # One row per partition of the job above.
    start = "coalesce(sum(n_ids) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS start"
    totals.selectExpr("shard", start, "n_docs", "n_ids").write.parquet(f"{path}/shards")


def _read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/{table}")


def _documents(batches: Iterator[pa.RecordBatch], low: int | None, high: int | None):
    for batch in batches:
        for row in range(batch.num_rows):
            yield _of_block({c: batch[c][row].as_py() for c in batch.schema.names}, low, high)


def _of_block(block: dict, low: int | None, high: int | None) -> pa.RecordBatch:
    nulls, ids = block["nulls"], block["ids"]
    ends, keys = EliasFano.from_bytes(block["ends"]), EliasFano.from_bytes(block["doc_ids"])
    begin = 0 if low is None else nulls + keys.find(low - 1)
    stop = len(ends) if high is None else nulls + keys.find(high)
    if begin >= stop:
        return _batch([], DOCUMENTS)
    if stop - begin == len(ends):
        bounds, named = [0, *ends.all().tolist()], [None] * nulls + keys.all().tolist()
    else:
        bounds = [ends.select(i) if i >= 0 else 0 for i in range(begin - 1, stop)]
        named = [keys.select(i - nulls) if i >= nulls else None for i in range(begin, stop)]
    base = block["start"] + block["first"]
    return _batch([(k, base + a, b - a, ids[4 * a : 4 * b]) for k, a, b in zip(named, bounds, bounds[1:])], DOCUMENTS)


def read_token_ids(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Documents as (doc_id, start, n_tokens, ids), those from ``low`` to ``high``.

    ``start`` counts the ids of all documents before it. A range of ids reads
    only blocks that hold some of it, and selects single boundaries in them. With a bound,
    documents without ``doc_id`` are left out where ``low`` is given and kept where
    only ``high`` is, as they come first.
    """
    blocks = _read(spark, path, "blocks", BLOCKS)
    if low is not None:
        blocks = blocks.where(F.col("largest_id") >= low)
    if high is not None:
        blocks = blocks.where((F.col("least_id") <= high) | (F.col("nulls") > 0))
    # The shards are as many as the writer's partitions, a few bytes each.
    placed = blocks.join(F.broadcast(_read(spark, path, "shards", SHARDS).select("shard", "start")), "shard")
    return placed.select("start", "first", "nulls", "ids", "ends", "doc_ids").mapInArrow(
        functools.partial(_documents, low=low, high=high), DOCUMENTS
    )


def token_checksums(documents: DataFrame) -> DataFrame:
    """The documents of ``read_token_ids`` with a checksum in place of their ids."""
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
